"""Conversation repair against exhaustive search over audits, whole and block by block."""

import hashlib
import random
import re
from itertools import product

import pytest

from recspark.llm import audits
from recspark.llm.conversation_repair import conversations, repair

from .conftest import both

SCHEMA = "conv_id bigint, turn bigint, role string, text string, block int, cost string, audit string, rows int"
TEXTS = ["yes.", "no!", "open", "", " \t", "why?", None, "yes.", "end. "]


def made(seed, rows, kinds=("user", "assistant", "system", "tool", None, "")):
    draw = random.Random(seed)
    return [(draw.choice([None, *range(6)]), draw.choice(kinds), draw.choice(TEXTS)) for _ in range(rows)]


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), text.encode())


def brute(rows):
    """Facts of one conversation by trying every way to put edits together."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    seen, kinds = set(), []
    for _, role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        fault = "b" if blank else "d" if (role, text) in seen else "" if re.search(r"[.!?][\x20\x09-\x0D]*$", text) else "t"
        seen.add((role, text))
        kinds.append(fault)
    best = {("", ""): (0, "", [])}  # last state, kept apart by the role sequence's legal states
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def offer(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def inserts(now):
        for _ in range(3):
            for (state, _), (cost, audit, out) in list(now.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        offer(now, (step[state, role[0]], ""), (cost + 5, audit + "I", [*out, f"{role}:"]))

    for (_, role, text), fault in zip(rows, kinds):
        inserts(best)
        after = {}
        for (state, _), (cost, audit, out) in best.items():
            offer(after, (state, ""), (cost + 2, audit + "D", out))
            if fault in ("b", "d"):
                continue
            extra = 5 if fault else 0
            for edit, new, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                if (state, new[:1]) in step:
                    offer(after, (step[state, new[:1]], ""), (cost + extra + price, audit + edit, [*out, f"{new}:{text}"]))
        best = after
    inserts(best)
    cost, audit, out = min((best[s] for s in best if s[0] in ("", "a")), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(kinds.count(k) for k in "bdt"),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def test_search_agrees_with_every_audit():
    """The reference of these tests against all strings of edits, on short conversations."""
    for seed, rows in product(range(12), (1, 2, 3)):
        own = sorted(((t, r or " ", x or " ") for t, r, x in made(seed, rows)), key=order)
        wanted = brute(own)[5:7]
        found = []
        for size in range(rows, rows + 3):
            for edits in product("DIKR", repeat=size):
                if sum(e != "I" for e in edits) != rows:
                    continue
                each, state, cost, seen, good = iter(own), "", 0, set(), True
                for edit in edits:
                    _, role, text = next(each) if edit != "I" else (None, "", "")
                    flawed = edit != "I" and (not text.strip(" \t\n\v\f\r") or (role, text) in seen)
                    if edit != "I":
                        seen.add((role, text))
                    if edit == "D":
                        cost += 2
                        continue
                    new = role[:1] if edit == "K" else "a" if state == "u" else "u"
                    good &= not flawed and (state + new) in ("s", "u", "su", "ua", "au")
                    cost += {"I": 5, "K": 0, "R": 1}[edit]
                    cost += 5 * (edit != "I" and text.rstrip(" \t\n\v\f\r")[-1:] not in (".", "!", "?"))
                    state = new
                if good and state in ("", "a"):
                    found.append((cost, "".join(edits)))
        assert min(found) == wanted


@pytest.mark.parametrize("prime", [audits._PRIME, 5])  # with 5 nearly all hashes collide
@pytest.mark.parametrize("size", [1, 3, 1000])
def test_blocks_give_the_same_audit(monkeypatch, prime, size):
    kind = audits.Audits
    monkeypatch.setattr(audits, "Audits", lambda: kind(prime))
    for seed in range(40):
        rows = sorted(((t, r or " ", x or " ") for t, r, x in made(seed, 3 + seed % 17, ("user", "assistant", "system"))), key=order)
        seen, marked = set(), []
        for t, r, x in rows:
            marked.append((t, r, x, 1, (r, x) not in seen))
            seen.add((r, x))
        blocks = [marked[i : i + size] for i in range(0, len(marked), size)]
        facts = audits.join([audits.summary(b) for b in blocks])
        ends = facts.pop("states")
        done = [audits.replay(b, e["start"], e["end"], i == len(blocks) - 1) for i, (b, e) in enumerate(zip(blocks, ends))]
        lines = [f"{r['role']}:{r['text']}" for d in done for r in d["repaired"]]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        assert (*(facts[n] for n in names), "".join(d["audit"] for d in done), digest) == brute(rows)


def test_operator(spark):
    groups = {i: made(i, i % 13) for i in range(60)}
    groups[None] = made(900, 9)
    groups[100] = [(i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(70)]
    groups[101] = [(None, "user", "again.")] * 40 + [(i // 3, "assistant", "same.") for i in range(30)]
    groups[102] = made(7, 90)
    rows = [(c, *r, 1, "c", "a", 2) for c, own in groups.items() for r in own]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    gone = spark.createDataFrame([(c, 0, "user", "dropped", 1, "c", "a", 2) for c in (0, 13, 100)], SCHEMA)
    from pyspark.sql import functions as F

    named = frame.withColumn("here", F.lit(True)).unionByName(gone.withColumn("here", F.lit(False)))
    wanted = [(c, *brute(own)) for c, own in groups.items() if own or c in (0, 13)]
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    for block_rows in (1000, 6):
        found = conversations(repair(named, F.col("here"), block_rows))
        assert found.columns == list(names)
        assert len(groups) - len(wanted) == 3
        got, want = both(found.collect(), wanted)
        assert got == want
    pieces = repair(named, F.col("here"), 6).where("conv_id = 100").collect()
    assert len(pieces) > 3 and {p.blocks for p in pieces} == {len(pieces)}


def test_empty(spark):
    assert conversations(repair(spark.createDataFrame([], SCHEMA))).count() == 0
