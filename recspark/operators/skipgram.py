"""Skip-gram with hierarchical softmax, trained in parts that hold no more than their own words.

The tree is a canonical Huffman code: words stand by falling count, so a word's rank alone gives
its code, and its inner nodes are the prefixes of the code. The lengths follow from how many words
have each count, so neither the vocabulary nor a vector is ever in the driver or in all tasks.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RATE = 0.025  # of learning, falling to nearly 0 over all passes
LONGEST = 1_000  # words of one sentence; longer ones are cut into several
STEP = 32  # words whose gradients are added up before the next ones see them
_SPAN = 8_192  # words whose contexts are drawn at a time
_FLAT = 6.0  # beyond it a product is taken as learnt


def code_lengths(histogram: Iterable[tuple[int, int]]) -> dict[int, int]:
    """`{length: words}` of a Huffman code, from `(count, words with that count)`.

    Words of one count are merged in pairs at once, so the work grows with the different counts.
    """
    heap = [(n, words, i) for i, (n, words) in enumerate(histogram) if words]
    leaves, above = len(heap), [[] for _ in heap]
    heapq.heapify(heap)

    def add(weight: int, number: int) -> int:
        above.append([])
        heapq.heappush(heap, (weight, number, len(above) - 1))
        return len(above) - 1

    while heap:
        weight, number, i = heapq.heappop(heap)
        if number == 1 and not heap:
            break
        if number > 1:
            above[i].append((add(2 * weight, number // 2), 2, 1))
            if number % 2:
                above[i].append((add(weight, 1), 1, 0))
            continue
        other, rest, j = heapq.heappop(heap)
        if rest > 1:
            above[j].append((add(other, rest - 1), 1, 0))
        parent = add(weight + other, 1)
        above[i].append((parent, 1, 1))
        above[j].append((parent, 1, 1))
    depths: list[Counter] = [Counter() for _ in above]
    for i in range(len(above) - 1, -1, -1):
        if not above[i]:
            depths[i][0] = 1  # the root
        for parent, times, down in above[i]:
            for depth, nodes in depths[parent].items():
                depths[i][depth + down] += times * nodes
    return dict(sorted(sum(depths[:leaves], Counter()).items()))


def codes_of(ranks: np.ndarray, lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Code and its length of the words at these places of the order by falling count."""
    size = np.array(list(lengths), np.int64)
    words = np.array(list(lengths.values()), np.int64)
    before = np.cumsum(words) - words
    first, code, last = [], 0, 0
    for length, number in lengths.items():
        code <<= length - last
        first.append(code)
        code, last = code + number, length
    at = np.searchsorted(before, ranks, side="right") - 1
    return np.array(first, np.int64)[at] + ranks - before[at], size[at]


def paths_of(codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes, and for each word their places from the root and the bits taken there.

    The words stand by rank, so equal prefixes are neighbours. Places after a word's length mean nothing.
    """
    longest = int(size.max(initial=0))
    way, bits = np.zeros((len(codes), longest), np.int32), np.zeros((len(codes), longest), np.uint8)
    names, known = [np.zeros(0, np.int64)], 0
    for depth in range(longest):
        first = np.searchsorted(size, depth, side="right")
        left = size[first:] - depth
        prefix = codes[first:] >> left
        new = np.r_[True, prefix[1:] != prefix[:-1]]
        way[first:, depth] = known + np.cumsum(new) - 1
        bits[first:, depth] = (codes[first:] >> (left - 1)) & 1
        names.append((1 << depth) + prefix[new])
        known += len(names[-1])
    return np.concatenate(names), way, bits


def _add(matrix: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
    """`matrix[places] += rows`, where places repeat."""
    order = np.argsort(places, kind="stable")
    places = places[order]
    starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    matrix[places[starts]] += np.add.reduceat(rows[order], starts, axis=0)


def first_vectors(ranks: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Small numbers that depend on the word's rank and the seed alone."""
    with np.errstate(over="ignore"):
        cell = ranks.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64)
        x = cell + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (((x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)) - np.float32(0.5)) / np.float32(size)


def train(
    words: np.ndarray,
    sentence: np.ndarray,
    inputs: np.ndarray,
    outputs: np.ndarray,
    paths: tuple[np.ndarray, np.ndarray, np.ndarray],
    window: int,
    rng: np.random.Generator,
    rounds: tuple[int, int, int],
) -> np.ndarray:
    """Change `inputs` and `outputs` in place; gives which inputs were changed.

    `words` are places of `inputs` and `sentence` their sentence, both in order. `paths` are the
    places in `outputs`, the bits and the length of the path of each word. `rounds` are the
    first pass made here, the one after the last, and all passes.
    """
    nodes, bits, size = paths
    shifts = np.r_[-window:0, 1 : window + 1]
    touched = np.zeros(len(inputs), bool)
    start, stop, passes = rounds
    for turn in range(start, stop):
        for low in range(0, len(words), _SPAN):
            places = np.arange(low, min(low + _SPAN, len(words)))
            near = places[:, None] + shifts
            reach = window - rng.integers(0, window, len(places))
            used = (near >= 0) & (near < len(words)) & (np.abs(shifts) <= reach[:, None])
            near = np.clip(near, 0, len(words) - 1)
            used &= sentence[near] == sentence[places][:, None]
            rate = np.float32(RATE * max(1 - (turn + low / len(words)) / passes, 1e-4))
            for at in range(0, len(places), STEP):
                own = words[places[at : at + STEP]]
                some = used[at : at + STEP]
                context = words[near[at : at + STEP]]
                longest = size[own].max()
                if not longest or not some.any():
                    continue
                way = nodes[own, :longest]
                on = np.arange(longest) < size[own][:, None]
                x, y = inputs[context], outputs[way]
                product = x @ y.transpose(0, 2, 1)
                wrong = (np.float32(1) - bits[own, :longest])[:, None, :] - 1 / (1 + np.exp(-product))
                wrong *= rate * (some[:, :, None] & on[:, None, :] & (np.abs(product) < _FLAT))
                _add(inputs, context[some], (wrong @ y)[some])
                _add(outputs, way[on], (wrong.transpose(0, 2, 1) @ x)[on])
                touched[context[some]] = True
    return touched


def _cut(lists: pa.ListArray, known: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The known words of all lists in one row, and the sentence of each."""
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    words = known[codes] if len(known) else np.full(len(codes), -1)
    row, words = row[words >= 0], words[words >= 0]
    begin = np.searchsorted(row, row)
    turn = (np.arange(len(row)) - begin) // LONGEST
    new = np.r_[True, (row[1:] != row[:-1]) | (turn[1:] != turn[:-1])] if len(row) else np.zeros(0, bool)
    return words, np.cumsum(new)


def vectors_column(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.ravel(), pa.float32()))


def matrix_of(vectors: pa.Array, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, size)


def train_part(
    lists: pa.Table, known: pa.Table, lengths: dict[int, int], size: int, window: int, seed: int, rounds: tuple[int, int, int]
) -> pa.Table:
    """`(part, id, token, touched, vector)` of all words and nodes of one part, after its passes.

    `lists` has its sentences as `(part, tokens)`, `known` what occurs in them as `(id, token, vector)`:
    words by rank and, once trained, the inner nodes by negative number. After the last pass the
    nodes are left out.
    """
    known = known.sort_by("id")
    is_word = pc.greater_equal(known["id"], 0)
    own, inner = known.filter(is_word), known.filter(pc.invert(is_word))
    tokens, ranks = own["token"].combine_chunks(), own["id"].to_numpy()
    codes, length = codes_of(ranks, lengths)
    names, way, bits = paths_of(codes, length)
    outputs = np.zeros((len(names), size), np.float32)
    if len(inner):
        outputs[np.searchsorted(names, -inner["id"].to_numpy())] = matrix_of(inner["vector"].combine_chunks(), size)
    fresh = own["vector"].null_count == len(own)
    inputs = first_vectors(ranks, size, seed) if fresh else matrix_of(own["vector"].combine_chunks(), size)
    part = lists["part"][0].as_py() if len(lists) else -1
    changed = np.zeros(len(inputs), bool)
    if len(lists):
        column = lists["tokens"].combine_chunks()
        coded = column.flatten().dictionary_encode(null_encoding="encode")
        places = pc.index_in(coded.dictionary, value_set=tokens).fill_null(-1).to_numpy(zero_copy_only=False)
        words, sentence = _cut(column, places.astype(np.int64), coded.indices.to_numpy(zero_copy_only=False))
        rng = np.random.default_rng([seed, part, rounds[0]])
        changed = train(words, sentence, inputs, outputs, (way, bits, length), window, rng, rounds)
    result = _rows(part, ranks, tokens, changed, inputs)
    if rounds[1] < rounds[2]:
        nothing = pa.nulls(len(names), pa.string())
        result += _rows(part, -names, nothing, np.ones(len(names), bool), outputs)
    return pa.Table.from_batches(result, PART)


PART = pa.schema([("part", pa.int64()), ("id", pa.int64()), ("token", pa.string()), ("touched", pa.bool_()), ("vector", pa.list_(pa.float32()))])


def _rows(part: int, ids: np.ndarray, tokens: pa.Array, touched: np.ndarray, matrix: np.ndarray) -> list[pa.RecordBatch]:
    """In batches of bounded size: a part has no more vectors than words and nodes, but these may be many."""
    found = []
    for at in range(0, len(ids), _SPAN):
        to = slice(at, at + _SPAN)
        columns = [np.full(len(ids[to]), part), ids[to], tokens[to], touched[to], vectors_column(matrix[to])]
        found.append(pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], schema=PART))
    return found


def mean_rows(rows: pa.Table, size: int) -> pa.Table:
    """`(id, token, vector)`: the mean over the parts that changed the vector; else all hold the same one."""
    names, first, place = np.unique(rows["id"].to_numpy(), return_index=True, return_inverse=True)
    weight = rows["touched"].to_numpy(zero_copy_only=False).astype(np.float32)
    weight[np.bincount(place, weight)[place] == 0] = 1
    order = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[order], np.arange(len(names)))
    weighted = (matrix_of(rows["vector"].combine_chunks(), size) * weight[:, None])[order]
    sums = np.add.reduceat(weighted, starts, axis=0, dtype=np.float64)
    mean = sums / np.bincount(place, weight)[:, None]
    return pa.table({"id": names, "token": rows["token"].take(pa.array(first)), "vector": vectors_column(mean.astype(np.float32))})
