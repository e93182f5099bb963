"""Exact substring dedup by suffix arrays of shards.

A byte goes when a string of `length` bytes that covers it also starts anywhere else, in the
same document or another; matches never cross documents.

1. Equal texts need no suffix array: with `length` bytes or more every byte of every copy
   goes, and one copy stands for all in what follows.
2. Every string of `length` bytes is named by an anchor, the 64-byte gram in it with the
   smallest hash (the leftmost of equal ones); grams with a period of half their length or
   less are taken only where a string has no others. Equal strings have equal anchors at equal
   places, so strings whose anchor occurs once are unique. What is left are the stretches
   around repeated anchors. A stretch that comes several times in one text is kept once: its
   bytes go wherever it stands, and one copy meets the other texts. So a text of a short
   period gives a few stretches, not one per period.
3. Equal stretches collapse to one with a count: a count above one repeats all its strings.
   Distinct stretches go to shards by anchor, so equal strings meet. A shard is bounded in
   bytes: an anchor with more stretches than a shard holds is dealt over several.
4. Each shard builds a suffix array in numpy by Larsson-Sadakane refinement, takes the common
   prefixes of neighbours by Kasai's scan (all stretches in step), and marks the strings that
   share `length` bytes with a neighbour.
5. Only shards of a divided anchor need more: each gives the sorted hashes of its strings, in
   ranges; the arrays of one range are merged by binary search in each other, and each shard
   gets back the hashes that another one has.
6. Marked strings become byte ranges of their documents, and ranges that touch are merged.

Strings within a shard are compared byte by byte; anchors, stretches and the strings of
divided anchors by 64-bit hashes, texts by 128 bits.

Defined cases: null and empty texts and texts below `length` bytes lose nothing; a cut may
split a UTF-8 character, so what is kept is binary; rows that repeat doc_id and text count as
two places, so both go; null doc_ids are ordinary; an empty table gives no rows; other
columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .bytesarrays import flat, prefix_hashes, slices, span_hashes, within
from .suffixes import suffix_order

LENGTH = 400
GRAM = 64
SHARD_BYTES = 2 << 20
PERIOD = GRAM // 2  # grams of this period or less are the last choice
_PIECE = 1 << 20
_PLACE_BITS = 22  # of a place in a piece, below the bits of its hash


def periodic_grams(data: np.ndarray, gram: int = GRAM, period: int = PERIOD) -> np.ndarray:
    """Whether the gram that starts at each place has a period of `period` or less."""
    found = np.zeros(len(data) - gram + 1, bool)
    for p in range(1, period + 1):
        same = data[p:] == data[:-p]
        # most texts have no such run: it holds three whole eights one after the other
        eights = same[: len(same) // 8 * 8].view(np.uint64) == 0x0101010101010101
        if not (eights[:-2] & eights[1:-1] & eights[2:]).any():
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
        low, high = edge[::2], edge[1::2]
        long = high - low >= gram - p
        for a, b in zip(low[long].tolist(), high[long].tolist()):
            found[a : b - (gram - p) + 1] = True
    return found


def anchors(data: np.ndarray, starts: np.ndarray, length: int, gram: int = GRAM):
    """Of flat texts: (text, anchor hash, anchor place, first and last string it names).

    A string is given by where it starts; a text's strings are named anchor by anchor.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) < length:
        return none
    places = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix_hashes(data), places, places + gram)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keyed = hashes >> np.uint64(1)
    keyed[periodic_grams(data, gram)] |= np.uint64(1 << 63)
    keyed = (keyed & ~low) | places.astype(np.uint64)
    width = length - gram + 1  # grams of one string
    padded = np.full(-(-len(keyed) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(keyed)] = keyed
    cells = padded.reshape(-1, width)
    forward = np.minimum.accumulate(cells, 1).ravel()
    backward = np.minimum.accumulate(cells[:, ::-1], 1)[:, ::-1].ravel()
    count = len(data) - length + 1
    least = np.minimum(backward[:count], forward[width - 1 : width - 1 + count])
    strings = np.maximum(np.diff(starts) - length + 1, 0)
    string = within(starts[:-1], strings)
    if not len(string):
        return none
    text = np.repeat(np.arange(len(strings)), strings)
    place = (least[string] & low).astype(np.int64)
    head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
    last = string[np.append(head[1:], len(string)) - 1]
    text, place, first = text[head], place[head], string[head]
    base = starts[text]
    return text, hashes[place].astype(np.int64), place - base, first - base, last - base


def _pieces(data: np.ndarray, starts: np.ndarray, length: int):
    """Slices of whole texts; a longer text comes in pieces that share `length` - 1 bytes.

    Yields (first row, place of the piece in its text, bytes, bounds).
    """
    for low, high in slices(starts, _PIECE):
        begin, end = int(starts[low]), int(starts[high])
        if high - low > 1 or end - begin <= _PIECE + length:
            yield low, 0, data[begin:end], starts[low : high + 1] - begin
            continue
        for at in range(0, max(end - begin - length + 1, 1), _PIECE):
            piece = data[begin + at : min(begin + at + _PIECE + length - 1, end)]
            yield low, at, piece, np.array([0, len(piece)])


def folded(data: np.ndarray, starts: np.ndarray, found: tuple, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the anchors found keep their stretch, and which stretches come again in their
    text. Of the equal stretches around one gram in a text the first is kept."""
    text, value, place, first, last = found
    keep, again = np.ones(len(text), bool), np.zeros(len(text), bool)
    by = np.lexsort((value, text))
    same = (text[by][1:] == text[by][:-1]) & (value[by][1:] == value[by][:-1])
    if not same.any():
        return keep, again
    rows = np.sort(by[np.concatenate((same, [False])) | np.concatenate(([False], same))])
    base = starts[text[rows]]
    hashes = span_hashes(prefix_hashes(data), base + first[rows], base + last[rows] + length)
    keys = (place[rows] - first[rows], hashes, value[rows], text[rows])
    by = np.lexsort(keys)
    same = np.logical_and.reduce([k[by][1:] == k[by][:-1] for k in keys])
    keep[rows[by[1:][same]]] = False
    again[rows[by[np.concatenate((same, [False])) | np.concatenate(([False], same))]]] = True
    return keep, again


def _anchor_rows(length: int):
    """Rows (anchor, text, place, first and last string), and with a null anchor the bytes
    (first to last) of stretches that come again in their text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(i).to_numpy() for i in (0, 1)]
            data, starts = flat(batch.column(2))
            for low, at, piece, bounds in _pieces(data, starts, length):
                text, value, place, first, last = anchors(piece, bounds, length)
                keep, again = folded(piece, bounds, (text, value, place, first, last), length)
                a, b, owner = first[again], last[again] + length, text[again]
                # stretches of a text follow each other; those that touch are one range
                head = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (a[1:] > b[:-1])))) if len(a) else np.zeros(0, np.int64)
                tail = np.append(head[1:], len(a))[: len(head)] - 1
                owner, a, b = owner[head], a[head], b[tail]
                rows = (value[keep], text[keep], place[keep] + at, first[keep] + at, last[keep] + at)
                anchor = pa.concat_arrays([pa.array(rows[0], pa.int64()), pa.nulls(len(a), pa.int64())])
                texts = np.concatenate((rows[1], owner)) + low
                columns = [ids[0][texts], ids[1][texts], *(np.concatenate(c) for c in ((rows[2], a + at), (rows[3], a + at), (rows[4], b + at)))]
                yield pa.RecordBatch.from_arrays([anchor, *(pa.array(c, pa.int64()) for c in columns)], ["anchor", "t1", "t2", "place", "first", "last"])

    return emit


def _stretches(length: int):
    """Rows (anchor, hash of the stretch, text, first string, bytes) of listed anchors."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "stretch", "t1", "t2", "first", "bytes"]
        for batch in batches:
            for row in range(batch.num_rows):
                t1, t2 = (batch.column(i)[row].as_py() for i in (0, 1))
                raw = batch.column(2)[row].as_buffer()
                listed = batch.column(3)[row].values
                anchor, first, last = (listed.field(c) for c in ("anchor", "first", "last"))
                parts = [raw[a : b + length] for a, b in zip(first.to_pylist(), last.to_pylist())]
                hashed = [int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little", signed=True) for p in parts]
                n = len(parts)
                columns = [anchor, pa.array(hashed, pa.int64()), pa.array([t1] * n, pa.int64()), pa.array([t2] * n, pa.int64()), first]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([p.to_pybytes() if hasattr(p, "to_pybytes") else bytes(p) for p in parts], pa.binary())], names)

    return emit


def repeated_strings(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, place) of every string of `length` bytes, in order, and whether it occurs
    again in these stretches: suffix array, then Kasai's scan of neighbours' prefixes."""
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1)
    codes = np.zeros(int(ends[-1]), np.int32)
    begins = ends - sizes - 1
    codes[within(begins, sizes)] = np.frombuffer(b"".join(parts), np.uint8)
    codes[ends - 1] = 256 + np.arange(len(parts))  # no two stretches end alike
    packed = codes.astype(np.int64)
    wide = np.concatenate((codes, np.zeros(3, np.int32)))
    bits = int(codes.max()).bit_length()
    for j in range(1, 3):  # the first round sorts by three codes at once
        packed = (packed << bits) | wide[j : j + len(codes)]
    order, _ = suffix_order(packed, int(sizes.max()) + 1, 3)
    del packed, wide, _
    # common prefix with the suffix before, along each stretch, from the prefix before less one
    strings = np.maximum(sizes - length + 1, 0)
    shared = np.zeros(len(codes), np.int32)
    previous = np.full(len(codes), -1, np.int32)
    previous[order[1:]] = order[:-1]
    padded = np.concatenate((codes, np.arange(length + 8, dtype=np.int32) + 256 + len(parts)))
    by = np.argsort(-strings, kind="stable")
    counts = strings[by]
    known = np.zeros(len(parts), np.int64)
    for step in range(int(counts[0])):
        alive = int(np.searchsorted(-counts, -step, "left"))
        place = begins[by[:alive]] + step
        other = previous[place]
        same = np.maximum(known[:alive] - 1, 0)
        same[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (same < length))
        while len(going):
            a, b = place[going] + same[going], other[going] + same[going]
            equal = padded[a] == padded[b]
            same[going] += equal
            going = going[equal & (same[going] < length)]
        known[:alive] = same
        shared[place] = same
    following = np.zeros(len(codes), np.int32)
    following[order[:-1]] = shared[order[1:]]
    string = within(begins, strings)
    again = (shared[string] >= length) | (following[string] >= length)
    return np.stack([np.repeat(np.arange(len(parts)), strings), within(np.zeros(len(parts), np.int64), strings)]), again


def _ranges(owner: np.ndarray, place: np.ndarray, length: int, owners: int) -> list[list[dict]]:
    """Byte ranges covered by marked strings of each owner."""
    out: list[list[dict]] = [[] for _ in range(owners)]
    if not len(owner):
        return out
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (place[1:] > place[:-1] + length)))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(owner)) - 1
    for o, a, b in zip(owner[head].tolist(), place[head].tolist(), (place[tail] + length).tolist()):
        out[o].append({"low": a, "high": b})
    return out


_RANGES = "array<struct<low:bigint,high:bigint>>"
_RANGE_TYPE = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))


def _string_hashes(part: bytes, length: int) -> np.ndarray:
    data = np.frombuffer(part, np.uint8)
    places = np.arange(max(len(data) - length + 1, 0))
    return span_hashes(prefix_hashes(data), places, places + length)


def marked(stretches: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(anchor, stretch, ranges): the bytes of distinct stretches (anchor, stretch, n, bytes)
    that lie in strings which occur again."""
    # anchors whose stretches all have copies need no shard; of others all stretches go there
    weight = stretches.groupBy("anchor").agg(F.min("n").alias("n"), F.sum(F.length("bytes")).alias("b")).where("n = 1")
    total = weight.agg(F.sum("b")).first()[0] or 0
    shards = max(stretches.sparkSession.sparkContext.defaultParallelism, -(-total // shard_bytes))
    parts = weight.select("anchor", F.ceil(F.col("b") / (2 * shard_bytes)).cast("int").alias("parts"))
    salt = F.when(F.col("parts") > 1, F.pmod("stretch", F.col("parts"))).otherwise(0)
    # a stretch with copies is marked whole, but others may share strings with it
    dealt = stretches.join(parts, "anchor")
    dealt = dealt.withColumns({"salt": salt.cast("int"), "divided": F.col("parts") > 1})
    shard = F.when(F.col("divided"), F.xxhash64("anchor", "salt")).otherwise(F.pmod("anchor", F.lit(shards)))
    dealt = materialize(dealt.withColumn("shard", shard).drop("parts"), "stretch-shards")

    def local(table: pa.Table) -> pa.Table:
        raw = [b.as_py() for b in table["bytes"]]
        (owner, place), again = repeated_strings(raw, length)
        ranges = _ranges(owner[again], place[again], length, len(raw))
        return pa.table([table["anchor"], table["stretch"], pa.array(ranges, _RANGE_TYPE)], ["anchor", "stretch", "ranges"])

    schema = f"anchor long, stretch long, ranges {_RANGES}"
    found = dealt.groupBy("shard").applyInArrow(local, schema)
    divided = dealt.where("divided").select("anchor", "stretch", "shard", "bytes")
    if divided.isEmpty():
        return found
    buckets = max(shards, 64)

    def sorted_hashes(table: pa.Table) -> pa.Table:
        hashes = np.unique(np.concatenate([_string_hashes(b.as_py(), length) for b in table["bytes"]]))
        edges = np.searchsorted(hashes, np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets))
        runs = [r.tobytes() for r in np.split(hashes, edges)]
        own = table["shard"][0].as_py()
        return pa.table([pa.array(range(buckets), pa.int64()), pa.array([own] * buckets, pa.int64()), pa.array(runs, pa.binary())], ["bucket", "shard", "hashes"])

    def merged(table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(h.as_buffer(), np.uint64) for h in table["hashes"]]
        every = np.sort(np.concatenate(arrays))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        shared = []
        for own in arrays:  # binary search of the merged ones in each shard's array
            at = np.minimum(np.searchsorted(own, twice), max(len(own) - 1, 0))
            shared.append(twice[own[at] == twice].tobytes() if len(own) else b"")
        return pa.table([table["shard"], pa.array(shared, pa.binary())], ["shard", "shared"])

    hashes = divided.groupBy("shard").applyInArrow(sorted_hashes, "bucket long, shard long, hashes binary")
    shared = hashes.groupBy("bucket").applyInArrow(merged, "shard long, shared binary")

    def across(own: pa.Table, other: pa.Table) -> pa.Table:
        there = np.sort(np.concatenate([np.frombuffer(h.as_buffer(), np.uint64) for h in other["shared"]] or [np.zeros(0, np.uint64)]))
        ranges = []
        for b in own["bytes"]:
            hashed = _string_hashes(b.as_py(), length)
            at = np.minimum(np.searchsorted(there, hashed), max(len(there) - 1, 0))
            place = np.flatnonzero(there[at] == hashed) if len(there) else np.zeros(0, np.int64)
            ranges += _ranges(np.zeros(len(place), np.int64), place, length, 1)
        return pa.table([own["anchor"], own["stretch"], pa.array(ranges, _RANGE_TYPE)], ["anchor", "stretch", "ranges"])

    return found.unionByName(divided.groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(across, schema))


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, removed, kept = [], [], []
        for text, ranges in zip(batch.column(1), batch.column(2).to_pylist()):
            raw, at, out, n = memoryview(text.as_buffer()), 0, [], 0
            end = -1
            for low, high in sorted((r["low"], r["high"]) for r in ranges or []):
                if low > end:
                    n += 1
                    out.append(raw[at:low])
                at = end = max(end, high)
            out.append(raw[at:])
            left = b"".join(out)
            spans.append(n)
            removed.append(len(raw) - len(left))
            kept.append(left)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t.as_buffer()) for t in batch.column(1)], pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of `docs` (doc_id, text)."""
    raw = F.coalesce("text", F.lit("")).cast("binary")
    texts = docs.select("doc_id", raw.alias("raw")).withColumns({"t1": F.xxhash64("raw"), "t2": F.xxhash64("raw", F.lit(1))})
    long_enough = F.length("raw") >= length
    copies = texts.where(long_enough).groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("one"))
    copies = materialize(copies, "copies")

    schema = "anchor long, t1 long, t2 long, place long, first long, last long"
    listed = texts.where(long_enough).select("t1", "t2", "raw").mapInArrow(_anchor_rows(length), schema)
    listed = materialize(listed, "anchors")
    inside = listed.where("anchor is null").select("t1", "t2", F.col("first").alias("low"), F.col("last").alias("high"))
    listed = listed.where("anchor is not null")
    occurrence = F.xxhash64("t1", "t2", "place")
    repeated = listed.groupBy("anchor").agg(F.min(occurrence).alias("a"), F.max(occurrence).alias("b")).where("a < b").select("anchor")
    # written before and grouped by text right after the join, so the adaptive join may split a hot anchor
    repeated = materialize(repeated, "repeated-anchors")
    one = F.struct("anchor", "first", "last")
    wanted = listed.join(repeated, "anchor").select("t1", "t2", one.alias("one"))
    # texts with repeats inside only are listed too, with no anchors
    wanted = wanted.unionByName(inside.select("t1", "t2", F.lit(None).cast(wanted.schema["one"].dataType).alias("one")))
    wanted = wanted.groupBy("t1", "t2").agg(F.collect_set("one").alias("listed"))
    known = copies.join(wanted, ["t1", "t2"], "left")
    # one copy carries the text on; other copies and texts without repeats are done here
    joined = texts.join(known, ["t1", "t2"], "left")
    alone = F.coalesce("copies", F.lit(1)) == 1
    open_text = F.col("listed").isNotNull() & (alone | F.col("doc_id").eqNullSafe(F.col("one")))
    joined = joined.select(
        "doc_id", "t1", "t2", "copies", alone.alias("alone"), F.length("raw").cast("long").alias("n_bytes"),
        F.when(open_text, F.col("listed")).alias("listed"), F.when(open_text, F.col("raw")).alias("raw"),
        F.when(alone & ~open_text, F.col("raw")).alias("kept"),
    )
    joined = materialize(joined, "texts-with-anchors")

    stretches = joined.where("size(listed) > 0").select("t1", "t2", "raw", "listed")
    stretches = stretches.mapInArrow(_stretches(length), "anchor long, stretch long, t1 long, t2 long, first long, bytes binary")
    stretches = materialize(stretches, "stretches")
    # rows that repeat doc_id and text bring a stretch twice from one place
    place = F.xxhash64("t1", "t2", "first")
    distinct = stretches.groupBy("anchor", "stretch").agg(
        F.when(F.min(place) < F.max(place), 2).otherwise(1).alias("n"), F.first("bytes").alias("bytes")
    )
    distinct = materialize(distinct, "distinct-stretches")
    found = materialize(marked(distinct, length, shard_bytes).where(F.size("ranges") > 0), "marked")

    owners = stretches.select("anchor", "stretch", "t1", "t2", "first", F.length("bytes").alias("size")).distinct()
    whole = distinct.where("n > 1").select("anchor", "stretch")
    all_of_it = owners.join(whole, ["anchor", "stretch"]).select("t1", "t2", F.col("first").alias("low"), (F.col("first") + F.col("size")).alias("high"))
    some = owners.join(found, ["anchor", "stretch"]).select("t1", "t2", "first", F.explode("ranges").alias("r"))
    some = some.select("t1", "t2", (F.col("first") + F.col("r.low")).alias("low"), (F.col("first") + F.col("r.high")).alias("high"))
    ranges = all_of_it.unionByName(some).unionByName(inside).groupBy("t1", "t2").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))

    open_rows = joined.where("alone and listed is not null").select("doc_id", "t1", "t2", "raw").join(ranges, ["t1", "t2"], "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = open_rows.select("doc_id", "raw", "ranges").mapInArrow(_cleaned, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    none = F.lit(0).cast("long")
    same = joined.where("alone and listed is null").select("doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), "kept")
    gone = joined.where("not alone").select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit("").cast("binary").alias("kept"))
    return cut.unionByName(same).unionByName(gone)
