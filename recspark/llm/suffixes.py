"""Suffix arrays of one shard in numpy."""

from __future__ import annotations

import numpy as np


def suffix_order(codes: np.ndarray, depth: int, h: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of `codes` and rank of each suffix, by Larsson-Sadakane refinement.

    Suffixes are ordered by their first `depth` codes at least. The rank is the place of the
    first suffix of a group, so suffixes that share those codes share their rank. `codes` may
    hold `h` codes each, those from its place on. Each round
    doubles the depth and sorts anew only groups that still hold several suffixes.
    """
    n = len(codes)
    place = np.int32 if n < 1 << 31 else np.int64  # half the memory wherever it does
    order = np.argsort(codes, kind="stable").astype(place)
    rank = np.full(n + 1, -1, place)
    if not n:
        return order, rank[:0]
    value = codes[order]
    first = np.concatenate(([True], value[1:] != value[:-1]))
    del value
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n, dtype=place), 0))
    last = np.concatenate((first[1:], [True]))
    open_places = np.flatnonzero(~(first & last)).astype(place)
    while h < depth and len(open_places):
        members = order[open_places]
        key = rank[members].astype(np.int64)
        key *= n + 1
        key += rank[np.minimum(members.astype(np.int64) + h, n)] + 1
        inner = np.argsort(key, kind="stable")
        members, key = members[inner], key[inner]
        del inner
        order[open_places] = members
        first = np.concatenate(([True], key[1:] != key[:-1]))
        last = np.concatenate((first[1:], [True]))
        rank[members] = np.maximum.accumulate(np.where(first, open_places, 0))
        open_places = open_places[~(first & last)]
        h *= 2
    return order, rank[:n]


def search(codes: np.ndarray, order: np.ndarray, wanted: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of `wanted`, the range of `order` whose suffixes begin with its first
    `length` codes: one binary search for all rows at once.

    `codes` must be followed by `wanted.shape[1]` codes below all wanted ones.
    """

    def bound(after: bool) -> np.ndarray:
        low = np.zeros(len(wanted), np.int64)
        high = np.full(len(wanted), len(order), np.int64)
        for _ in range(int(len(order)).bit_length()):
            active = low < high
            middle = (low + high) >> 1
            at = order[np.minimum(middle, len(order) - 1)]
            smaller = np.zeros(len(wanted), bool)
            same = np.ones(len(wanted), bool)
            for j in range(wanted.shape[1]):
                here, there = codes[at + j], wanted[:, j]
                use = same & (j < lengths)
                smaller |= use & (here < there)
                same &= ~use | (here == there)
            right = active & (smaller | (same if after else False))
            low = np.where(right, middle + 1, low)
            high = np.where(active & ~right, middle, high)
        return low

    if not len(order) or not len(wanted):
        none = np.zeros(len(wanted), np.int64)
        return none, none
    return bound(False), bound(True)
