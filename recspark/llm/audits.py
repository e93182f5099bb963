"""Least-cost edit audits of a conversation's rows: a dynamic program over persistent prefixes.

After each row the program keeps, for each state of the role pattern `(s?(ua)+)?`, the cheapest
audit (a string of D, I, K, R) that reaches it. Audits are nodes of a shared tree: a node has
its parent, its edit, a rolling hash and ancestors 1, 2, 4, .. edits back. Of equally cheap
audits the ASCII-least wins: their longest common prefix is searched by the hashes of ancestors,
the prefixes of equal hash are verified edit by edit up to a node known to be equal, and the
edits behind them decide. Equally cheap audits of one state have equally many row edits, so none
is a prefix of another and the least prefix stays least.

Rows come in blocks. A block's result has, for each pair of states before and behind it, the
cost and the rank of its best audit. Inserts go before a row, or behind the last one of all, so
audits of a block are never prefixes of each other, and comparing ranks block by block
compares whole audits: `join` runs the same program over blocks, and `replay` gives a block's
audit and repaired rows once its states are known.
"""

from __future__ import annotations

import re
from functools import cmp_to_key

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
_TO_USER = (EMPTY, SYSTEM, ASSISTANT)
_TAILS = {EMPTY: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
_FAR = float("inf")
_SEEN = re.compile(r"[^\x20\x09-\x0D]")
_WHITE = " \t\n\v\f\r"
_LEGAL = {"su", "ua", "au"}
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Prefixes as linked nodes; node 0 is the empty one."""

    def __init__(self, prime: int = _PRIME):
        self.prime = prime
        self.parent, self.edit, self.depth, self.hash = [0], [None], [0], [0]
        self.up: list[list[int]] = [[]]
        self.equal: dict[int, int] = {}

    def add(self, parent: int, edit) -> int:
        node = len(self.parent)
        self.parent.append(parent)
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        code = ord(edit) if isinstance(edit, str) else edit + 2
        self.hash.append((self.hash[parent] * _BASE + code) % self.prime)
        ancestors, above, step = [parent], parent, 0
        while len(self.up[above]) > step:
            above = self.up[above][step]
            ancestors.append(above)
            step += 1
        self.up.append(ancestors)
        return node

    def edits(self, node: int) -> list:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.parent[node]
        return out[::-1]

    def _lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            step = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][step]
        return node

    def _find(self, node: int) -> int:
        while node in self.equal:
            node = self.equal[node]
        return node

    def _same(self, x: int, y: int) -> bool:
        """Whether two prefixes of equal depth and hash are equal, edit by edit."""
        walked = []
        x, y = self._find(x), self._find(y)
        while x != y:
            if self.edit[x] != self.edit[y]:
                return False
            walked.append((x, y))
            x, y = self._find(self.parent[x]), self._find(self.parent[y])
        for a, b in walked:
            a, b = self._find(a), self._find(b)
            if a != b:
                self.equal[max(a, b)] = min(a, b)
        return True

    def compare(self, x: int, y: int) -> int:
        depth = min(self.depth[x], self.depth[y])
        a, b = self._lifted(x, depth), self._lifted(y, depth)
        if self.hash[a] == self.hash[b] and self._same(a, b):
            return (self.depth[x] > depth) - (self.depth[y] > depth)
        if self.hash[a] != self.hash[b]:
            for step in range(len(self.up[a]) - 1, -1, -1):
                if step < len(self.up[a]) and self.hash[self.up[a][step]] != self.hash[self.up[b][step]]:
                    a, b = self.up[a][step], self.up[b][step]
            if self._same(self.parent[a], self.parent[b]):
                return -1 if self.edit[a] < self.edit[b] else 1
        left, right = self.edits(x), self.edits(y)  # hashes collided
        return (left > right) - (left < right)

    def best(self, ways: list[tuple]) -> tuple[float, int]:
        """The cheapest of (cost, prefix, edits behind it), as (cost, node)."""
        least = min((w[0] for w in ways), default=_FAR)
        if least == _FAR:
            return _FAR, 0
        chosen = None
        for cost, node, edits in ways:
            if cost == least:
                for edit in edits:
                    node = self.add(node, edit)
                if chosen is None or self.compare(node, chosen) < 0:
                    chosen = node
        return least, chosen


def faults(rows: list[tuple]) -> list[tuple[str, str]]:
    """(role initial, fault) of rows (turn, role, text, copies, first); `first` says that no
    earlier row has this role and text, None that the rows are all there is to look through."""
    out, seen = [], set()
    for _, role, text, copies, first in rows:
        if first is None:
            first = (role, text) not in seen
            seen.add((role, text))
        blank = not _SEEN.search(text)
        cut = not blank and text.rstrip(_WHITE)[-1] not in ".!?"
        for copy in range(copies):
            fault = "blank" if blank else "duplicate" if copy or not first else "truncated" if cut else ""
            out.append((role[:1], fault))
    return out


def _after(audits: Audits, states: list[tuple], initial: str, fault: str) -> list[tuple]:
    """States behind one row: inserts, then the row is deleted, kept or given another role."""
    now = list(states)
    now[USER] = audits.best([(*now[USER], ""), *((now[s][0] + INSERT, now[s][1], "I") for s in _TO_USER)])
    now[ASSISTANT] = audits.best([(*now[ASSISTANT], ""), (now[USER][0] + INSERT, now[USER][1], "I")])
    ways = [[(now[s][0] + DELETE, now[s][1], "D")] for s in range(4)]
    if fault in ("", "truncated"):
        cost = TRUNCATED if fault else 0
        for state in _TO_USER:
            ways[USER].append((now[state][0] + cost + REROLE, now[state][1], "R"))
            if initial == "u":
                ways[USER].append((now[state][0] + cost, now[state][1], "K"))
        ways[ASSISTANT].append((now[USER][0] + cost + REROLE, now[USER][1], "R"))
        if initial == "a":
            ways[ASSISTANT].append((now[USER][0] + cost, now[USER][1], "K"))
        if initial == "s":
            ways[SYSTEM].append((now[EMPTY][0] + cost, now[EMPTY][1], "K"))
    return [audits.best(w) for w in ways]


def _run(audits: Audits, kinds: list[tuple[str, str]], start: int) -> list[tuple]:
    states = [(0, 0) if s == start else (_FAR, 0) for s in range(4)]
    for initial, fault in kinds:
        states = _after(audits, states, initial, fault)
    return states


def summary(rows: list[tuple], starts: tuple[int, ...] = (EMPTY, SYSTEM, USER, ASSISTANT)) -> dict:
    """What `join` needs of a block: counts, both ends, and the best audits as (cost, rank)."""
    kinds = faults(rows)
    initials = [k[0] for k in kinds]
    turns = [r[0] for r in rows if r[0] is not None and r[3]]
    counted = {f: sum(k[1] == f for k in kinds) for f in ("blank", "duplicate", "truncated")}
    audits, found = Audits(), {}
    for start in starts:
        for end, (cost, node) in enumerate(_run(audits, kinds, start)):
            if cost != _FAR:
                found[start, end] = cost, node
    order = sorted(found, key=cmp_to_key(lambda p, q: audits.compare(found[p][1], found[q][1])))
    ranks, rank = {}, -1
    for i, pair in enumerate(order):
        if not i or audits.compare(found[order[i - 1]][1], found[pair][1]):
            rank += 1
        ranks[pair] = rank
    return counted | {
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "first": initials[0] if initials else None,
        "last": initials[-1] if initials else None,
        "low": min(turns, default=None),
        "high": max(turns, default=None),
        "turns": len(set(turns)),
        "ways": [{"start": s, "end": e, "cost": found[s, e][0], "rank": ranks[s, e]} for s, e in order],
    }


def join(blocks: list[dict]) -> dict:
    """Counts and cost of a conversation of blocks in order, and the states each begins and ends with."""
    audits = Audits()
    states = [(0, 0) if s == EMPTY else (_FAR, 0) for s in range(4)]
    behind = {}
    for block in blocks:
        ways: list[list] = [[] for _ in range(4)]
        for w in block["ways"]:
            cost, node = states[w["start"]]
            if cost != _FAR:
                after = audits.add(node, w["rank"])
                behind[after] = w["start"], w["end"]
                ways[w["end"]].append((cost + w["cost"], after, ()))
        states = [audits.best(w) for w in ways]
    tails = []
    for state, (cost, node) in enumerate(states):
        if cost != _FAR:
            tails.append((cost + INSERT * len(_TAILS[state]), audits.add(node, len(_TAILS[state])), ()))
    cost, node = audits.best(tails)
    path = []
    node = audits.parent[node]
    while node:
        path.append(behind[node])
        node = audits.parent[node]
    total = {k: sum(b[k] for b in blocks) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    filled = [b for b in blocks if b["first"] is not None]
    total["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(filled, filled[1:]))
    timed = [b for b in blocks if b["low"] is not None]
    total["turns"] -= sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
    gaps = timed[-1]["high"] - timed[0]["low"] + 1 - total.pop("turns") if timed else total.pop("turns")
    return total | {"gaps": gaps, "cost": cost, "states": [{"start": s, "end": e} for s, e in path[::-1]]}


def replay(rows: list[tuple], start: int, end: int, closing: bool) -> dict:
    """The block's audit between two states, and its repaired rows; `closing` adds the inserts at the end."""
    audits, kinds = Audits(), faults(rows)
    _, node = _run(audits, kinds, start)[end]
    edits = "".join(audits.edits(node)) + (_TAILS[end] if closing else "")
    each = ((role, text) for _, role, text, copies, _ in rows for _ in range(copies))
    state, out = start, []
    for edit in edits:
        role, text = next(each) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == USER else "user"
        state = ASSISTANT if state == USER else SYSTEM if edit == "K" and role[:1] == "s" else USER
        out.append({"role": role, "text": text})
    return {"audit": edits, "repaired": out}
