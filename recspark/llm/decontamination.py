"""Benchmark decontamination by suffix arrays of the training texts.

Each task cuts its documents into shards of a few MB, builds a suffix array over the word
ids of a shard and binary-searches every benchmark suffix in it. Windows found next to each
other on one diagonal merge into the longest verbatim matches, which carry their places.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters. A benchmark
suffix is looked up by its first `window` words; an item with fewer words is one window.
Only training suffixes whose first words begin some benchmark window enter the array: no
other can match. Words are compared by 64-bit hashes.

The benchmark goes to the tasks in blocks of at most `block_bytes` of text (usually one),
so no broadcast grows with it; documents never leave their partition.

Defined cases: null or empty texts and texts without words match nothing; an item without
words has no windows; repeated documents get equal results and repeated items count as one
item_id; a null item_id is reported as an empty string; empty tables give no matches;
columns named like the new ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .bytesarrays import LOWER, flat, give_back, mix, ordered_hashes, runs, slices, within
from .suffixes import search, suffix_order

WINDOW = 10
SHARD = 4 << 20  # bytes of text per suffix array
_GRAM = 3  # words by which a training suffix is admitted to the array
_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[0x80:] = True
MATCH = "array<struct<item_id:string,item_word:int,doc_word:int,words:int>>"


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each text (one more entry at the end)."""
    lowered = LOWER[data]
    first, last = runs(_WORD[lowered], starts)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    return ordered_hashes(lowered, first, last), np.searchsorted(first, starts)


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` codes from each place on (fewer places than codes)."""
    out = np.zeros(max(len(codes) - size + 1, 0), np.uint64)
    for j in range(size):
        out = mix(out + codes[j : j + len(out)].astype(np.uint64) + np.uint64(j + 1))
    return out


@dataclass(frozen=True)
class Suffixes:
    """The windows of one block of benchmark items."""

    vocabulary: np.ndarray  # sorted word hashes; a word's code is its place + 1
    windows: np.ndarray  # codes, one row per window, 0 beyond its length
    lengths: np.ndarray
    item: np.ndarray  # row of `ids` for each window
    place: np.ndarray  # word of the item at which the window begins
    ids: list[str]
    admitted: dict[int, tuple[np.ndarray, int]]  # words per gram: sorted grams, shortest window


def benchmark_suffixes(ids: list[str], texts: pa.Array, window: int = WINDOW) -> Suffixes:
    hashes, bounds = words(*flat(texts))
    vocabulary = np.unique(hashes)
    codes = np.searchsorted(vocabulary, hashes) + 1
    counts = np.diff(bounds)
    windows = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
    first = within(bounds[:-1], windows)
    lengths = np.repeat(np.minimum(counts, window), windows)
    padded = np.concatenate((codes, np.zeros(window, np.int64)))
    table = padded[first[:, None] + np.arange(window)]
    table[np.arange(window) >= lengths[:, None]] = 0
    admitted = {}
    for size in np.unique(np.minimum(lengths, _GRAM)).tolist():
        own = np.minimum(lengths, _GRAM) == size
        grams = np.unique(np.concatenate([_grams(row[:size], size) for row in table[own]]))
        admitted[size] = (grams, int(lengths[own].min()))
    return Suffixes(vocabulary, table, lengths, np.repeat(np.arange(len(counts)), windows), within(np.zeros(len(counts), np.int64), windows), ids, admitted)


def shard_matches(data: np.ndarray, starts: np.ndarray, tests: Suffixes):
    """Word counts of the shard's texts, and its longest matches as columns
    (text, item row, item word, text word, words), ordered by text."""
    hashes, bounds = words(data, starts)
    counts = np.diff(bounds)
    nothing = tuple(np.zeros(0, np.int64) for _ in range(5))
    if not len(hashes) or not len(tests.lengths):
        return counts, nothing
    code = np.searchsorted(tests.vocabulary, hashes)
    code[code == len(tests.vocabulary)] = 0
    code = np.where(tests.vocabulary[code] == hashes, code + 1, 0)
    known_first, known_last = runs(code > 0, bounds)
    reach = np.zeros(len(code), np.int64)  # known words from here on
    lengths = known_last - known_first
    places = within(known_first, lengths)
    reach[places] = np.repeat(known_last, lengths) - places
    start = np.zeros(len(code), bool)
    for size, (grams, shortest) in tests.admitted.items():
        likely = np.flatnonzero(reach >= shortest)
        if not len(likely):
            continue
        gram = np.zeros(len(likely), np.uint64)
        for j in range(size):
            gram = mix(gram + code[likely + j].astype(np.uint64) + np.uint64(j + 1))
        at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
        start[likely[grams[at] == gram]] = True
    if not start.any():
        return counts, nothing
    # the admitted suffixes with the words that follow them, a separator between stretches
    depth = tests.windows.shape[1]
    spread = np.zeros(len(code) + 1, np.int64)
    began = np.flatnonzero(start)
    np.add.at(spread, began, 1)
    np.add.at(spread, began + np.minimum(reach[began], depth), -1)
    first, last = runs(np.cumsum(spread[:-1]) > 0, bounds)
    size = last - first
    text_place = within(first, size + 1)  # one place more for the separator
    kept = np.zeros(len(text_place) + depth, np.int64)
    inside = np.ones(len(text_place), bool)
    inside[np.cumsum(size + 1) - 1] = False
    kept[: len(text_place)][inside] = code[text_place[inside]]
    order, _ = suffix_order(kept[: len(text_place)], depth)
    order = order[inside[order]]
    low, high = search(kept, order, tests.windows, tests.lengths)
    found = np.flatnonzero(high > low)
    if not len(found):
        return counts, nothing
    hits = high[found] - low[found]
    window = np.repeat(found, hits)
    word = text_place[order[within(low[found], hits)]]
    text = np.searchsorted(bounds, word, "right") - 1
    item, place, length = tests.item[window], tests.place[window], tests.lengths[window]
    word = word - bounds[text]
    by = np.lexsort((place, place - word, item, text))
    text, item, place, word, length = (x[by] for x in (text, item, place, word, length))
    new = np.ones(len(by), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | ((place - word)[1:] != (place - word)[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(new)
    steps = np.diff(np.append(head, len(by))) - 1
    return counts, (text[head], item[head], place[head], word[head], length[head] + steps)


def _find(texts: pa.Array, tests: Suffixes) -> pa.Array:
    data, starts = flat(texts)
    counts, parts, per_text = [], [], []
    for first, last in slices(starts, SHARD):
        own = data[starts[first] : starts[last]]
        n, columns = shard_matches(own, starts[first : last + 1] - starts[first], tests)
        counts.append(n)
        per_text.append(np.bincount(columns[0], minlength=last - first))
        parts.append(columns[1:])
    joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*parts) if parts else [()] * 4)]
    names = pa.array(tests.ids, pa.string()).take(pa.array(joined[0], pa.int64()))
    structs = pa.StructArray.from_arrays([names, *[pa.array(c, pa.int32()) for c in joined[1:]]], ["item_id", "item_word", "doc_word", "words"])
    bounds = np.concatenate(([0], np.cumsum(np.concatenate(per_text)))) if per_text else [0]
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs)
    total = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays([pa.array(total, pa.int64()), lists], ["n_words", "matches"])


def _finder(tests):
    @arrow_udf(f"struct<n_words:bigint,matches:{MATCH}>")
    def find(texts: pa.Array) -> pa.Array:
        found = _find(texts, tests.value)
        give_back()
        return found

    return find


def _covered(matches: pa.Array) -> pa.Array:
    """Words that lie in at least one of the matches."""
    spans = matches.flatten()
    owner = np.repeat(np.arange(len(matches)), matches.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    out = np.zeros(len(matches), np.int64)
    if len(spans):
        first = spans.field("doc_word").to_numpy().astype(np.int64)
        end = first + spans.field("words").to_numpy()
        by = np.lexsort((end, first, owner))
        owner, first, end = owner[by], first[by], end[by]
        room = int(end.max()) + 1
        first, end = first + owner * room, end + owner * room
        reached = np.concatenate(([0], np.maximum.accumulate(end)[:-1]))
        np.add.at(out, owner, np.maximum(end - np.maximum(first, reached), 0))
    return pa.array(out)


def with_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 32 << 20) -> DataFrame:
    """Add n_words, n_hit and `matches`, the longest verbatim matches of at least one window:
    (item_id, word of the item, word of the text, words)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    context = docs.sparkSession.sparkContext
    found = docs
    for b in range(blocks):
        rows = items.where(block == b).distinct().toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])
        tests = context.broadcast(benchmark_suffixes(rows["item_id"].to_pylist(), rows["text"], window))

        found = found.withColumn(f"_found{b}", _finder(tests)("text"))
    matches = F.concat(*[F.col(f"_found{b}.matches") for b in range(blocks)])
    found = found.withColumns({"n_words": F.col("_found0.n_words"), "matches": matches})
    return found.withColumn("n_hit", arrow_udf("bigint")(_covered)("matches")).drop(*[f"_found{b}" for b in range(blocks)])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, whole and with their own columns."""
    columns = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    judged = with_matches(numbered.withColumn("text", F.col(f"c{columns.index('text')}")), benchmark, window)
    return judged.where(F.col("n_hit") == 0).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
