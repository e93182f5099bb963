"""Periodic runs of words, found by recompression, and texts with each run cut to one period.

A run is a maximal stretch of words with smallest period q and at least max(least, 3 q) words.
For each period p the places of a grid are candidates, with a step so small that each run has a
place whose next `GRAM` words, and those p later, lie inside it: the steps grow with p, so there
are O(n log n) places. Places whose `GRAM` words differ from those p later drop out; for the
others, extension queries on the run-length grammar (see `grammar`) give the exact stretch.
Of equal stretches the smallest period is kept, which is that of the stretch.

A task works through its rows in slices of about `SLICE` words, so no rows are shuffled and
memory follows the slice or the longest text. Words `[^\\x20\\x09-\\x0D]+` are compared whole.

Defined cases: null and empty texts have no words, no runs and an empty collapsed text; repeated
rows give equal results; input columns named like the new ones are replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .bytesarrays import flat, slices
from .grammar import Grammar

LEAST = 24
GRAM = 4
SLICE = 1 << 18
QUERIES = 1 << 20
BYTES = 1 << 22
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_TYPE = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))),
        ("collapsed", pa.string()),
    ]
)


def _grid_step(period: int, least: int) -> int:
    return max(least, 3 * period) - period - GRAM + 1


def _grams(words: np.ndarray) -> np.ndarray:
    codes = words.astype(np.uint64) + np.uint64(1)
    mixed = codes[: len(codes) - GRAM + 1].copy()
    for i in range(1, GRAM):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - GRAM + 1 + i]
        mixed ^= mixed >> np.uint64(31)
    return mixed


def _candidates(words: np.ndarray, starts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) in slices: the `GRAM` words there and a period later look equal."""
    grams = _grams(words)
    places, periods, held = [], [], 0
    for period in range(1, int(np.diff(starts).max()) // 3 + 1):
        if period >= len(grams):
            break
        step = _grid_step(period, least)
        hits = np.flatnonzero(grams[:-period:step] == grams[period::step]) * step
        if not len(hits):
            continue
        # a stretch lies in one text
        hits = hits[np.searchsorted(starts, hits, "right") == np.searchsorted(starts, hits + period, "right")]
        if len(hits):
            places.append(hits)
            periods.append(np.full(len(hits), period))
            held += len(hits)
        if held > QUERIES:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def runs_of(words: np.ndarray, starts: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (text, start, length, period), in this order, of flat texts of word numbers."""
    found = np.zeros((0, 4), np.int64)
    if len(words) < GRAM:
        return found
    grammar = place = None
    for at, period in _candidates(words, starts, least):
        if grammar is None:
            # only texts with candidates enter the grammar; all of them may have more in later slices
            texts = _texts_to_parse(words, starts, least, at)
            kept = np.concatenate([np.arange(starts[t], starts[t + 1]) for t in texts])
            sizes = np.diff(starts)[texts]
            grammar = Grammar(words[kept], np.concatenate(([0], np.cumsum(sizes))))
            place = np.full(len(words), -1)
            place[kept] = grammar.place
        x, y = place[at], place[at + period]
        before, after = grammar.extension(x, y, back=True), grammar.extension(x, y)
        length = before + after + period
        good = length >= np.maximum(least, 3 * period)
        text = np.searchsorted(starts, at[good], "right") - 1
        rows = np.stack((text, at[good] - before[good] - starts[text], length[good], period[good]), 1)
        found = np.unique(np.concatenate((found, rows)), axis=0)
        same = (found[1:, :3] == found[:-1, :3]).all(1)
        found = found[np.concatenate(([True], ~same))] if len(found) else found
    order = np.lexsort((found[:, 3], found[:, 1], found[:, 0]))
    return found[order]


def _texts_to_parse(words: np.ndarray, starts: np.ndarray, least: int, at: np.ndarray) -> np.ndarray:
    """Texts of the first slice's candidates; all texts if there are more slices."""
    owners = np.unique(np.searchsorted(starts, at, "right") - 1)
    return owners if len(at) <= QUERIES else np.flatnonzero(np.diff(starts))


def _slices(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Texts in order of size, about `SLICE` words each: periods go up to a third of the longest."""
    order = np.argsort(sizes, kind="stable")
    total = np.cumsum(sizes[order])
    at = 0
    while at < len(order):
        base = total[at] - sizes[order[at]]
        end = max(int(np.searchsorted(total, base + SLICE, "right")), at + 1)
        yield order[at:end]
        at = end


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 1] + runs[:, 3], 1)
        np.add.at(change, runs[:, 1] + runs[:, 2], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
    return b" ".join(words).decode()


def _described(texts: pa.Array, least: int) -> pa.Array:
    _, at = flat(texts)
    return pa.chunked_array([_part(texts[a:b], least) for a, b in slices(at, BYTES)], _TYPE).combine_chunks()


def _part(texts: pa.Array, least: int) -> pa.Array:
    # bytes are split at 0x20 and 0x09-0x0D
    split = [t.split() if t else [] for t in texts.cast(pa.binary()).to_pylist()]
    sizes = np.array([len(w) for w in split], np.int64)
    results: list[dict | None] = [None] * len(split)
    for rows in _slices(sizes):
        starts = np.concatenate(([0], np.cumsum(sizes[rows])))
        words = pa.array([w for r in rows for w in split[r]], pa.binary())
        runs = runs_of(words.dictionary_encode().indices.to_numpy().astype(np.int64), starts, least)
        bounds = np.searchsorted(runs[:, 0], np.arange(len(rows) + 1))
        for i, row in enumerate(rows):
            own = runs[bounds[i] : bounds[i + 1]]
            named = [{"start": s, "length": n, "period": p} for _, s, n, p in own.tolist()]
            results[row] = {"n_words": int(sizes[row]), "runs": named, "collapsed": _collapsed(split[row], own)}
    return pa.array(results, _TYPE)


def with_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """Add `n_words`, `runs` (start, length, period; by start, then period) and `collapsed`:
    the words outside of runs and the first period of each run, joined by one space."""

    @arrow_udf(f"struct<n_words:bigint,runs:{_RUNS},collapsed:string>")
    def described(texts: pa.Array) -> pa.Array:
        return _described(texts, least)

    found = docs.withColumn("runs", described(text))
    return found.withColumns({k: F.col("runs")[k] for k in ("n_words", "collapsed", "runs")})


def strongest(runs: str) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first."""
    first = F.get(runs, F.lit(0))
    return F.aggregate(
        runs, first, lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    )
