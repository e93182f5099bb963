"""Sequence packing: shortest-pack-first over the length histogram.

Texts become token ids with an end id. A text longer than a sequence is cut into whole
sequences and a rest; the rests are packed. Only the histogram of rest lengths (at most
`limit` numbers) reaches the driver: lengths are placed longest first, each onto the packs
with the fewest tokens that still have room, and what is counted are packing patterns, not
documents. A pattern with a larger gap is cut into sequences whose lengths are powers of two
(they need no padding), so little padding is left whatever the histogram looks like.

Patterns meet documents by rank. A document's rank among the rests of one length is its
place within its partition plus the counts of earlier partitions, so no group of documents
passes through one task; the rank and the pattern table then give sequence and offset.

Encoded rests are written once, as the cuts at powers of two depend on the histogram.

Defined cases: a null or empty text is the end id alone; repeated rows are packed like any
others; equal lengths keep the order of the input; empty tables give no pieces; other
columns of the documents are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..operators.skew import is_small
from ..storage import materialize
from .bytesarrays import give_back
from .tokens import Encoder, with_end

LIMIT = 2048
GAP = 32  # a sequence with more padding than this is cut at powers of two


@dataclass(frozen=True)
class Slots:
    """Where the rests go, by length and rank: rank ranges of equal treatment.

    Row s holds the ranks from `rank[s]` on of `length[s]`; the k-th of them lies in pack
    `pack[s] + k` of its pattern, `offset[s]` ids from the pack's beginning.
    """

    key: np.ndarray  # length << 40 | first rank, ascending
    pack: np.ndarray
    offset: np.ndarray
    pattern: np.ndarray  # of each row
    first_sequence: np.ndarray  # of each pattern
    first_pack: np.ndarray  # of each pattern
    cuts: list[list[int]]  # of each pattern: where its sequences begin, and its end
    sequences: int


def shortest_pack_first(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of placing) and how many packs have each."""
    by_total: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        grown: list[tuple[int, tuple[int, ...], int]] = []
        for total in sorted(by_total):
            if total + length > limit or not left:
                break
            rest = []
            for pattern, count in by_total[total]:
                # a pack may take the same length several times over
                used = min(count, left)
                if used:
                    grown.append((total + length, (*pattern, length), used))
                    left -= used
                if count > used:
                    rest.append((pattern, count - used))
            by_total[total] = rest
        while left:
            if grown and grown[0][0] + length <= limit:
                total, pattern, count = grown.pop(0)
                used = min(count, left)
                if count > used:
                    grown.insert(0, (total, pattern, count - used))
                grown.append((total + length, (*pattern, length), used))
                left -= used
                continue
            per_pack = min(limit // length, left)
            packs, odd = divmod(left, per_pack)
            grown.append((per_pack * length, (length,) * per_pack, packs))
            if odd:
                grown.append((odd * length, (length,) * odd, 1))
            left = 0
        for total, pattern, count in grown:
            by_total.setdefault(total, []).append((pattern, count))
        by_total = {t: p for t, p in by_total.items() if p}
    return [(p, c) for total in sorted(by_total) for p, c in by_total[total] if c]


def _cuts(total: int, limit: int, gap: int) -> list[int]:
    """Where sequences of a pack begin, and its end: powers of two until the gap is small."""
    cuts, left = [0], total
    while left & (left - 1) and limit - left > gap:
        part = 1 << (left.bit_length() - 1)
        cuts.append(cuts[-1] + part)
        left -= part
    return [*cuts, total] if left else cuts


def slots(histogram: dict[int, int], limit: int = LIMIT, gap: int = GAP) -> Slots:
    patterns = shortest_pack_first(histogram, limit)
    used: dict[int, int] = dict.fromkeys(histogram, 0)
    rows, cuts, first_sequence, first_pack = [], [], [], []
    sequence = pack = 0
    for number, (lengths, count) in enumerate(patterns):
        at = 0
        for length in lengths:
            rows.append((length << 40 | used[length], pack, at, number))
            used[length] += count
            at += length
        cuts.append(_cuts(at, limit, gap))
        first_sequence.append(sequence)
        first_pack.append(pack)
        pack += count
        sequence += count * (len(cuts[-1]) - 1)
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Slots(table[:, 0], table[:, 1], table[:, 2], table[:, 3], np.array(first_sequence, np.int64), np.array(first_pack, np.int64), cuts, sequence)


def _encoded(tokenizer: str, limit: int):
    """Per text: id count, crc32 of its whole sequences, its rest, and the rest's place
    among those of its length in this partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(limit, np.int64)  # rests of each length so far
        full = 0
        coder = Encoder(tokenizer)  # of this task alone: the worker runs other stages next
        for batch in batches:
            docs = batch.column(0)
            for low, ids, first in coder.texts(batch.column(1)):
                ids, first = with_end(ids, first)
                raw = memoryview(ids.astype("<u4").tobytes())
                counts = np.diff(first)
                rest = counts % limit
                local = np.empty(len(counts), np.int64)
                by = np.argsort(rest, kind="stable")
                fresh = np.concatenate(([True], rest[by][1:] != rest[by][:-1]))
                local[by] = np.arange(len(by)) - np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
                local += seen[rest]
                seen += np.bincount(rest, minlength=limit)
                wholes = counts // limit
                whole = full + np.cumsum(wholes) - wholes
                full += int(wholes.sum())
                starts = first[:-1].tolist()
                crcs = [
                    [zlib.crc32(raw[4 * (s + k * limit) : 4 * (s + (k + 1) * limit)]) for k in range(w)]
                    for s, w in zip(starts, wholes.tolist())
                ]
                tails = [bytes(raw[4 * (e - r) : 4 * e]) for e, r in zip(first[1:].tolist(), rest.tolist())]
                rows = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.slice(low, rows),
                        pa.array(counts),
                        pa.array(crcs, pa.list_(pa.int64())),
                        pa.array(tails, pa.binary()),
                        pa.array([zlib.crc32(t) for t in tails], pa.int64()),
                        pa.array(rest),
                        pa.array(np.full(rows, part, np.int64)),
                        pa.array(local),
                        pa.array(whole),
                    ],
                    ["doc_id", "doc_tokens", "crcs", "rest_ids", "rest_crc", "rest", "part", "local", "whole"],
                )
        del coder
        give_back()

    return encode


def pack(docs: DataFrame, tokenizer: str, limit: int = LIMIT, gap: int = GAP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, doc_tokens long, crcs array<long>, rest_ids binary, rest_crc long, rest long, part long, local long, whole long"
    encoded = docs.select("doc_id", "text").mapInArrow(_encoded(tokenizer, limit), schema)
    encoded = materialize(encoded, "encoded")

    counts = encoded.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "rests")
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect() if r["rest"]}
    table = slots(histogram, limit, gap)
    shared = spark.sparkContext.broadcast(table)

    # whole sequences, numbered after those of the packs
    wholes = encoded.groupBy("part").agg(F.sum(F.size("crcs")).alias("n"))
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    wholes = wholes.select("part", (F.coalesce(F.sum("n").over(running), F.lit(0)) + table.sequences).alias("first"))
    full = (
        encoded.where(F.size("crcs") > 0)
        .select("doc_id", "doc_tokens", "part", "whole", F.posexplode("crcs").alias("k", "ids_crc32"))
        .join(wholes, "part")
        .select(
            "doc_id",
            (F.col("k") * limit).cast("long").alias("start"),
            F.lit(limit).cast("long").alias("length"),
            "ids_crc32",
            "doc_tokens",
            (F.col("first") + F.col("whole") + F.col("k")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )

    placed_kind = "struct<first:bigint,at:bigint,cuts:array<bigint>>"

    @arrow_udf(placed_kind)
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        """The pack's first sequence, the rest's offset in it, and the pack's inner cuts."""
        s = shared.value
        length, rank = (x.to_numpy(zero_copy_only=False) for x in (length, rank))
        row = np.searchsorted(s.key, length << 40 | rank, "right") - 1
        number = s.pattern[row]
        packs = s.pack[row] + rank - (s.key[row] & ((1 << 40) - 1))
        per_pack = np.array([len(c) - 1 for c in s.cuts], np.int64)[number]
        first = s.first_sequence[number] + (packs - s.first_pack[number]) * per_pack
        cuts = pa.array([s.cuts[n][1:-1] for n in number.tolist()], pa.list_(pa.int64()))
        return pa.StructArray.from_arrays([pa.array(first), pa.array(s.offset[row]), cuts], ["first", "at", "cuts"])

    ranks = encoded.where(F.col("rest") > 0).select("doc_id", "doc_tokens", "part", "rest", "local", "rest_crc")
    ranks = ranks.join(counts.select("part", "rest", "before"), ["part", "rest"])
    ranks = ranks.withColumn("placed", place("rest", F.col("before") + F.col("local")))
    ranks = ranks.select("*", F.col("placed.first").alias("first"), F.col("placed.at").alias("at"), F.col("placed.cuts").alias("cuts"))
    # cuts that fall inside this rest
    inner = F.filter("cuts", lambda c: (c > F.col("at")) & (c < F.col("at") + F.col("rest")))
    ranks = ranks.withColumn("inner", inner)
    skipped = F.size(F.filter("cuts", lambda c: c <= F.col("at")))
    began = F.coalesce(F.array_max(F.filter("cuts", lambda c: c <= F.col("at"))), F.lit(0))
    whole_rests = ranks.where(F.size("inner") == 0).select(
        "doc_id",
        (F.col("doc_tokens") - F.col("rest")).alias("start"),
        F.col("rest").alias("length"),
        F.col("rest_crc").alias("ids_crc32"),
        "doc_tokens",
        (F.col("first") + skipped).alias("sequence_id"),
        (F.col("at") - began).alias("offset"),
    )

    @arrow_udf("array<struct<start:bigint,length:bigint,ids_crc32:bigint,skipped:bigint,offset:bigint>>")
    def pieces(ids: pa.Array, at: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        for raw, begin, inside in zip(ids.to_pylist(), at.to_pylist(), cuts.to_pylist()):
            end, rows = begin + len(raw) // 4, []
            bounds = [0, *inside, max(end, inside[-1] if inside else 0)]
            for number, (low, high) in enumerate(zip(bounds, bounds[1:])):
                a, b = max(low, begin), min(high, end) if number < len(inside) else end
                if a < b:
                    own = raw[4 * (a - begin) : 4 * (b - begin)]
                    rows.append({"start": a - begin, "length": b - a, "ids_crc32": zlib.crc32(own), "skipped": number, "offset": a - low})
            out.append(rows)
        return pa.array(out, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "ids_crc32", "skipped", "offset")])))

    # usually few packs are cut; their rests then find their ids without moving the others
    cut = materialize(ranks.where(F.size("inner") > 0).select("part", "rest", "local", "first", "at", "cuts"), "cut")
    cut = F.broadcast(cut) if is_small(cut) else cut
    cut = (
        encoded.select("doc_id", "doc_tokens", "part", "rest", "local", "rest_ids")
        .join(cut, ["part", "rest", "local"])
        .select("doc_id", "doc_tokens", "rest", "first", F.explode(pieces("rest_ids", "at", "cuts")).alias("p"))
        .select(
            "doc_id",
            (F.col("doc_tokens") - F.col("rest") + F.col("p.start")).alias("start"),
            "p.length",
            "p.ids_crc32",
            "doc_tokens",
            (F.col("first") + F.col("p.skipped")).alias("sequence_id"),
            "p.offset",
        )
    )
    return full.unionByName(whole_rests).unionByName(cut)
