"""Recompression of word sequences: a run-length grammar with extension queries.

Rounds alternate block compression (a maximal block a^k becomes one symbol) and pair
compression (symbols are parted in left and right, every adjacent left-right pair becomes one
symbol) until no two symbols of a sequence are adjacent. Both depend on nothing but the
symbols met, so equal stretches are parsed alike except at one symbol a round and side: an
extension query climbs while symbols start together, then descends, and takes at most one
step a round in each direction. Many sequences share one grammar; barriers part them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Round:
    """`parent`: each symbol's index one round up; `first`: where each upper symbol's children begin."""

    block: bool
    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray


def _blocks(symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, int]:
    first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    counts = np.diff(np.append(first, len(symbols)))
    upper = symbols[first].copy()
    long = np.flatnonzero(counts > 1)
    if len(long):
        keys = upper[long] * np.int64(len(symbols) + 1) + counts[long]
        names, named = np.unique(keys, return_inverse=True)
        upper[long] = fresh + named
        fresh += len(names)
    return upper, first, fresh


def _pairs(symbols: np.ndarray, joined: np.ndarray, fresh: int, salt: int) -> tuple[np.ndarray, np.ndarray, int]:
    mixed = (symbols.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    side = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63) == 1
    ways = [joined & side[:-1] & ~side[1:], joined & ~side[:-1] & side[1:]]
    taken = ways[0] if ways[0].sum() >= ways[1].sum() else ways[1]
    at = np.flatnonzero(taken)
    kept = np.ones(len(symbols), bool)
    kept[at + 1] = False
    first = np.flatnonzero(kept)
    renamed = symbols.copy()
    if len(at):
        names, named = np.unique(symbols[at] * np.int64(fresh) + symbols[at + 1], return_inverse=True)
        renamed[at] = fresh + named
        fresh += len(names)
    return renamed[first], first, fresh


class Grammar:
    """`words`: small non-negative numbers of all sequences, one after the other; a barrier
    stands before each of them and behind the last (see `place`)."""

    def __init__(self, words: np.ndarray, starts: np.ndarray):
        count = len(starts)
        owner = np.repeat(np.arange(count - 1), np.diff(starts))
        self.place = np.arange(len(words)) + owner + 1
        barriers = starts + np.arange(count)
        symbols = np.empty(len(words) + count, np.int64)
        symbols[barriers] = np.arange(count)
        symbols[self.place] = words + count
        fresh = count + (int(words.max()) + 1 if len(words) else 0)
        self.rounds: list[Round] = []
        while True:
            for block in (True, False):
                joined = (symbols[:-1] >= count) & (symbols[1:] >= count)
                if block:
                    upper, first, fresh = _blocks(symbols, fresh)
                else:
                    upper, first, fresh = _pairs(symbols, joined, fresh, len(self.rounds))
                inside = np.zeros(len(symbols), np.int64)
                inside[first[1:]] = 1
                self.rounds.append(Round(block, symbols, np.cumsum(inside), np.append(first, len(symbols))))
                symbols = upper
            if not ((symbols[:-1] >= count) & (symbols[1:] >= count)).any():
                self.top = symbols
                return

    def extension(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """Equal words from places x and y on, or before them when `back`; x < y."""
        step = -1 if back else 1
        x, y = (x - 1, y - 1) if back else (x.copy(), y.copy())
        began = x.copy()
        height = np.full(len(x), len(self.rounds), np.int64)
        active = np.arange(len(x))
        for level, now in enumerate(self.rounds):
            a, b = x[active], y[active]
            same = now.symbols[a] == now.symbols[b]
            edges = self._at_edge(now, a, back) & self._at_edge(now, b, back)
            walk = same & ~edges
            if walk.any():
                a[walk], b[walk] = self._consumed(now, a[walk], b[walk], step)
                same[walk] = self._at_edge(now, a[walk], back) & self._at_edge(now, b[walk], back)
            x[active], y[active] = a, b
            height[active[~same]] = level
            active = active[same]
            x[active], y[active] = now.parent[x[active]], now.parent[y[active]]
            if not len(active):
                break
        for level in range(len(self.rounds) - 1, -1, -1):
            down = np.flatnonzero(height > level)
            if not len(down):
                continue
            now = self.rounds[level]
            a, b = (now.first[p[down] + 1] - 1 if back else now.first[p[down]] for p in (x, y))
            same = now.symbols[a] == now.symbols[b]
            a[same], b[same] = self._consumed(now, a[same], b[same], step)
            x[down], y[down] = a, b
        return (x - began) * step

    @staticmethod
    def _at_edge(now: Round, at: np.ndarray, back: bool) -> np.ndarray:
        up = now.parent[at]
        return (now.first[up + 1] - 1 if back else now.first[up]) == at

    @staticmethod
    def _consumed(now: Round, a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Past equal symbols: one of a pair, or what both blocks have left."""
        if not now.block:  # equal symbols never begin two pairs each
            return a + step, b + step
        left = []
        for at in (a, b):
            up = now.parent[at]
            left.append(now.first[up + 1] - at if step > 0 else at - now.first[up] + 1)
        take = np.minimum(*left) * step
        return a + take, b + take
