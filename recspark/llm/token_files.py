"""Token-id files with a minimal perfect hash index.

`write` sorts documents by doc_id over range partitions; each task encodes its documents and
appends their ids, each document followed by the end id, to one shard file of raw little-
endian unsigned integers (two bytes an id where the vocabulary allows, else four). Rows of
the index (key, shard, offset, length) are dealt into buckets of bounded size, and each
bucket becomes one file: a minimal perfect hash of its keys and, at the slot of each key, a
32-bit fingerprint and the place of its ids. A lookup costs one hash per level (two on
average), one fingerprint comparison and one read, whatever the number of documents.

The perfect hash is a cascade of bit arrays: a key whose bit no other key of its level
shares stays there, the others go to the next level; the slot is the number of bits before.

Files go to the shared folder under a temporary name and are renamed when whole, so a task
that is run again writes the same file anew and readers never see half a file.

Defined cases: a null or empty text is the end id alone; null doc_ids come first; a doc_id
that occurs again gets the key (doc_id, place) with its place in the order, the first one
(doc_id, 0); equal doc_ids are ordered by the hash of their text; keys not in the files give
no row; an empty table gives no shards; other columns are not carried.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import materialize, new_path
from .bytesarrays import mix
from .tokens import encoder, with_end

KEYS_PER_BUCKET = 50_000
_LEVELS = 40
_ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8"), ("start", "<u8")])


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _write_whole(path: str, parts) -> None:
    fs, at = _open(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    temporary = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        for part in parts:
            out.write(part)
    fs.move(temporary, at)


class PerfectHash:
    """Slots 0 to n - 1 of distinct 64-bit keys."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, overflow: np.ndarray):
        self.bits = bits  # packed, all levels one after the other
        self.sizes = sizes  # of each level, in bits
        self.overflow = overflow  # sorted keys that no level separates
        per_byte = np.bitwise_count(bits).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(per_byte)))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, sizes, left = [], [], keys
        while len(left) and len(sizes) < _LEVELS:
            size = -(-2 * len(left) // 8) * 8
            place = cls._place(left, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            left = left[~alone[place]]
        bits = np.concatenate(levels) if levels else np.zeros(0, np.uint8)
        return cls(bits, np.array(sizes, np.int64), np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 or a slot of another key for keys never given."""
        out = np.full(len(keys), -1, np.int64)
        left, shift = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                return out
            place = self._place(keys[left], level, size) + shift
            byte, bit = place >> 3, (place & 7).astype(np.uint8)
            here = self.bits[byte] >> bit & 1 == 1
            below = self.bits[byte] & ((np.uint8(1) << bit) - np.uint8(1))
            out[left[here]] = (self.before[byte] + np.bitwise_count(below))[here]
            left, shift = left[~here], shift + size
        if len(left) and len(self.overflow):
            at = np.minimum(np.searchsorted(self.overflow, keys[left]), len(self.overflow) - 1)
            found = self.overflow[at] == keys[left]
            out[left[found]] = self.before[-1] + at[found]
        return out

    def dump(self) -> bytes:
        head = struct.pack("<QQQ", len(self.sizes), len(self.bits), len(self.overflow))
        return head + self.sizes.astype("<i8").tobytes() + self.bits.tobytes() + self.overflow.astype("<u8").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> tuple[PerfectHash, int]:
        """The hash, and where it ends in `raw`."""
        levels, size, over = struct.unpack_from("<QQQ", raw)
        at = 24
        sizes = np.frombuffer(raw, "<i8", levels, at)
        bits = np.frombuffer(raw, np.uint8, size, at + 8 * levels)
        end = at + 8 * levels + size
        return cls(bits, sizes, np.frombuffer(raw, "<u8", over, end)), end + 8 * over


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def key(doc_id: Column | str, place: Column | str) -> Column:
    return F.xxhash64(doc_id, place)


@dataclass(frozen=True)
class TokenFiles:
    spark: SparkSession
    folder: str
    width: int  # bytes an id
    buckets: int
    keys: DataFrame  # doc_id, place: the keys written

    def shard(self, number: int) -> str:
        return f"{self.folder}/shard-{number:06d}.ids"

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Places of the ids of `keys` (doc_id, place), by the index files."""
        folder, buckets = self.folder, self.buckets
        dealt = keys.select("doc_id", "place", key("doc_id", "place").alias("key"))
        dealt = dealt.withColumn("bucket", F.pmod("key", F.lit(buckets)))
        kind = keys.schema["doc_id"].dataType.simpleString()

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, loaded = None, None
            for batch in batches:
                bucket = batch.column(3).to_numpy()
                head = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
                for low, high in zip(head, [*head[1:], len(bucket)]):
                    if number != bucket[low]:
                        number = int(bucket[low])
                        loaded = _load_bucket(folder, number)
                    perfect, entries = loaded
                    wanted = batch.column(2).slice(low, high - low).to_numpy().astype(np.uint64)
                    slot = perfect.slots(wanted)
                    there = slot >= 0
                    entry = entries[np.where(there, slot, 0)] if len(entries) else np.zeros(len(slot), _ENTRY)
                    rows = np.flatnonzero(there & (entry["print"] == fingerprints(wanted)))
                    taken = pa.array(rows + low)
                    columns = [batch.column(0).take(taken), batch.column(1).take(taken)]
                    columns += [pa.array(entry[c][rows].astype(np.int64)) for c in ("shard", "offset", "length", "start")]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "shard", "offset", "length", "start"])

        schema = f"doc_id {kind}, place long, shard long, offset long, length long, start long"
        return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(find, schema)

    def payload(self, places: DataFrame) -> DataFrame:
        """`places` with `ids`, read from the shard files: little-endian unsigned 32-bit."""
        return self._read(places, "ids binary", lambda ids: pa.array([i.tobytes() for i in ids], pa.binary()))

    def checksums(self, places: DataFrame) -> DataFrame:
        """`places` with `ids_crc32`, of the ids read from the shard files."""
        return self._read(places, "ids_crc32 long", lambda ids: pa.array([zlib.crc32(i) for i in ids], pa.int64()))

    def _read(self, places: DataFrame, column: str, made) -> DataFrame:
        folder, width = self.folder, self.width

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, source = None, None
            for batch in batches:
                shard, offset, length = (batch.column(i).to_pylist() for i in (2, 3, 4))
                step = 256  # texts in memory at once
                for low in range(0, len(shard), step):
                    ids = []
                    for s, o, n in zip(shard[low : low + step], offset[low : low + step], length[low : low + step]):
                        if s != number:
                            number = s
                            fs, at = _open(f"{folder}/shard-{s:06d}.ids")
                            source = fs.open_input_file(at)
                        ids.append(np.frombuffer(source.read_at(n * width, o * width), f"<u{width}").astype("<u4"))
                    part = batch.slice(low, step)
                    yield pa.RecordBatch.from_arrays([*part.columns, made(ids)], [*batch.schema.names, column.split()[0]])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in places.schema) + f", {column}"
        near = places.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
        return near.mapInArrow(read, schema)


def _load_bucket(folder: str, number: int) -> tuple[PerfectHash, np.ndarray]:
    fs, at = _open(f"{folder}/index-{number:06d}.mph")
    if fs.get_file_info(at).type == pafs.FileType.NotFound:
        return PerfectHash.build(np.zeros(0, np.uint64)), np.zeros(0, _ENTRY)
    with fs.open_input_file(at) as source:
        raw = source.read()
    perfect, end = PerfectHash.load(raw)
    return perfect, np.frombuffer(raw, _ENTRY, offset=end)


def _write_shards(folder: str, tokenizer: str, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder = encoder(tokenizer)
        fs, at = _open(f"{folder}/shard-{part:06d}.ids")
        temporary = f"{at}.{uuid.uuid4().hex}"
        offset, row = 0, 0
        with fs.open_output_stream(temporary) as out:
            for batch in batches:
                for low, ids, first in coder.texts(batch.column(1)):
                    ids, first = with_end(ids, first)
                    out.write(ids.astype(f"<u{width}").tobytes())
                    rows = len(first) - 1
                    columns = [batch.column(0).slice(low, rows), pa.array(np.full(rows, part, np.int64)), pa.array(np.arange(row, row + rows))]
                    columns += [pa.array(first[:-1] + offset), pa.array(np.diff(first))]
                    offset, row = offset + int(first[-1]), row + rows
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "row", "offset", "length"])
        if row:
            fs.move(temporary, at)
        else:
            fs.delete_file(temporary)

    return write


def write(docs: DataFrame, tokenizer: str, vocabulary: int) -> TokenFiles:
    """Encode and write all of `docs` (doc_id, text); `vocabulary`: ids are below it."""
    spark = docs.sparkSession
    folder = new_path(spark, "token-files")
    fs, at = _open(folder)
    fs.create_dir(at, recursive=True)
    width = 2 if vocabulary <= 1 << 16 else 4
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = ["doc_id", "_tie"]
    ordered = docs.select("doc_id", "text").withColumn("_tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = ordered.mapInArrow(_write_shards(folder, tokenizer, width), f"doc_id {kind}, shard long, row long, offset long, length long")
    rows = materialize(rows, "token-rows")

    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard").agg(F.sum("length").alias("n"))
    bases = bases.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    place = F.shiftleft("shard", 40) + F.col("row")
    first = rows.groupBy("doc_id").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    first = first.select(F.col("doc_id").alias("_doc"), "_first")
    known = rows.join(bases, "shard").join(first, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    again = F.when(F.col("_first") < place, place + 1).otherwise(F.lit(0))
    index = known.select("doc_id", again.alias("place"), "shard", "offset", "length", (F.col("base") + F.col("offset")).alias("start"))
    index = materialize(index.withColumn("key", key("doc_id", "place")), "token-index")
    buckets = max(1, -(-index.count() // KEYS_PER_BUCKET))

    def build(table: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy().astype(np.uint64)
        perfect = PerfectHash.build(keys)
        slot = perfect.slots(keys)
        entries = np.zeros(len(keys), _ENTRY)
        entries["print"][slot] = fingerprints(keys)
        for column in ("shard", "offset", "length", "start"):
            entries[column][slot] = table[column].to_numpy()
        bucket = table["bucket"][0].as_py()
        _write_whole(f"{folder}/index-{bucket:06d}.mph", [perfect.dump(), entries.tobytes()])
        return pa.table({"bucket": [bucket], "n": [len(keys)]})

    dealt = index.select("key", "shard", "offset", "length", "start", F.pmod("key", F.lit(buckets)).alias("bucket"))
    materialize(dealt.groupBy("bucket").applyInArrow(build, "bucket long, n long"), "token-buckets")
    return TokenFiles(spark, folder, width, buckets, index.select("doc_id", "place"))
