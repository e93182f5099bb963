"""Cheapest repair of conversations: which rows to keep, give another role, delete or insert.

Per conversation, in the order of turn (nulls first), then role, then text: each row's fault
(blank, duplicate, truncated), gaps in turns, illegal neighbours, and the least-cost audit that
makes the roles `(s?(ua)+)?`, of equally cheap ones the ASCII-least, by the program in `audits`.

A conversation of up to `block_rows` rows is solved where its rows meet. A longer one is dealt
out: equal rows are counted first, first copies are found by an aggregate and a salted join,
the rest is range-partitioned in order and written. Tasks then reduce their blocks of rows to
costs and ranks, these few numbers meet per conversation, and tasks replay their blocks with the
states chosen. So no task holds a long conversation.

Defined cases: null roles and texts count as one space; rows where `present` does not hold only
name their conversation; one without rows has zeros, an empty audit and one empty block; a null
conversation id is a conversation; rows of one turn follow role and text; rows that agree in all
three are copies; other columns are not carried, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..operators.skew import attach
from ..storage import materialize
from . import audits

BLOCK_ROWS = 1000
BLOCK_BYTES = 1 << 20
_ROWS = ("turn", "role", "text", "copies", "first")
_FACTS = "gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint"
_BLOCK = "audit:string,repaired:array<struct<role:string,text:string>>"
_STATES = "array<struct<start:int,end:int>>"
_SUMMARY = (
    "blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,first:string,last:string,low:bigint,"
    "high:bigint,turns:bigint,ways:array<struct<start:int,end:int,cost:bigint,rank:int>>"
)


def _arrow(ddl: str) -> pa.DataType:
    return to_arrow_type(DataType.fromDDL(ddl))


def _rows(cell: list[dict]) -> list[tuple]:
    return [tuple(r[k] for k in _ROWS) for r in cell]


def _whole(frame: DataFrame) -> DataFrame:
    kind = _arrow(f"struct<{_FACTS},{_BLOCK}>")

    @arrow_udf(f"struct<{_FACTS},{_BLOCK}>")
    def solved(cells: pa.Array) -> pa.Array:
        out = []
        for cell in cells.to_pylist():
            rows = _rows(cell)
            facts = audits.join([audits.summary(rows, (audits.EMPTY,))])
            ends = facts.pop("states")[0]
            out.append(facts | audits.replay(rows, ends["start"], ends["end"], True))
        return pa.array(out, kind)

    return frame.select("conv_id", F.lit(0).alias("block"), F.lit(1).alias("blocks"), solved("rows").alias("s")).select(
        "conv_id", "block", "blocks", "s.*"
    )


def _dealt(rows: DataFrame, block_rows: int) -> DataFrame:
    """Long conversations, block by block."""
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    counted = materialize(counted, "turn-rows")
    order = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    known = counted.groupBy("conv_id", "role", "text").agg(F.min(order).alias("earliest"), F.count(F.lit(1)).alias("n"))
    # a null id is no key of a join
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    keyed = counted.withColumn("key", key)
    known = materialize(known.withColumn("key", key).drop("conv_id"), "first-turns")
    flagged = attach(keyed, known, ["key", "role", "text"], rows_per_task=block_rows)
    flagged = flagged.withColumn("first", F.col("earliest").eqNullSafe(order)).drop("earliest", "key")
    parts = max(1, -(-flagged.count() // block_rows))
    flagged = flagged.repartitionByRange(parts, "conv_id", "turn", "role", "text")
    blocks = materialize(flagged.withColumn("block", F.spark_partition_id()), "blocks")
    cell = F.array_sort(F.collect_list(F.struct(*_ROWS))).alias("rows")
    blocks = materialize(blocks.groupBy("conv_id", "block").agg(cell), "block-rows")
    kind, totals = _arrow(f"struct<{_SUMMARY}>"), _arrow(f"struct<{_FACTS},states:{_STATES}>")

    @arrow_udf(f"struct<{_SUMMARY}>")
    def summed(cells: pa.Array) -> pa.Array:
        return pa.array([audits.summary(_rows(c)) for c in cells.to_pylist()], kind)

    @arrow_udf(f"struct<{_FACTS},states:{_STATES}>")
    def joined(cells: pa.Array) -> pa.Array:
        return pa.array([audits.join([b["summary"] for b in c]) for c in cells.to_pylist()], totals)

    found = blocks.select("conv_id", "block", summed("rows").alias("summary"))
    found = found.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "summary"))).alias("cell"))
    found = found.select("conv_id", "cell.block", joined("cell").alias("s"))
    states = found.select(
        "conv_id", F.size("block").alias("blocks"), "s.*", F.posexplode(F.arrays_zip("block", "s.states")).alias("at", "own")
    ).drop("states")
    states = materialize(states.select("*", "own.*").drop("own"), "block-states")
    block = _arrow(f"struct<{_BLOCK}>")

    @arrow_udf(f"struct<{_BLOCK}>")
    def replayed(cells: pa.Array, states: pa.Array, last: pa.Array) -> pa.Array:
        asked = zip(cells.to_pylist(), states.to_pylist(), last.to_pylist())
        return pa.array([audits.replay(_rows(c), s["start"], s["end"], end) for c, s, end in asked], block)

    b, s = blocks.alias("b"), states.alias("s")
    met = b.join(s, F.col("b.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("b.block") == F.col("s.block")))
    ends = replayed("rows", "states", F.col("at") == F.col("blocks") - 1)
    # the counts stand with the first block
    facts = [F.when(F.col("at") == 0, F.col(f.split(":")[0])).alias(f.split(":")[0]) for f in _FACTS.split(",")]
    return met.select("b.conv_id", F.col("at").alias("block"), "blocks", *facts, ends.alias("r")).select("*", "r.*").drop("r")


def repair(rows: DataFrame, present: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (conv_id, block, blocks, counts, cost, audit, repaired): one per conversation, or
    one per block of a long one, whose counts and cost stand with block 0."""
    present = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = rows.select("conv_id", F.col("turn").cast("long"), role, text, present.alias("present"))
    size = F.sum(F.when(F.col("present"), F.octet_length("text")))
    sizes = rows.groupBy("conv_id").agg(F.count_if("present").alias("n"), size.alias("bytes"))
    long = materialize(sizes.where((F.col("n") > block_rows) | (F.col("bytes") > BLOCK_BYTES)).select("conv_id"), "long")
    if long.isEmpty():
        short = rows
    else:  # at most rows / block_rows, or bytes / BLOCK_BYTES, ids
        same = F.col("r.conv_id").eqNullSafe(F.col("l.conv_id"))
        short = rows.alias("r").join(F.broadcast(long.alias("l")), same, "left_anti")
    one = F.struct("turn", "role", "text", F.lit(1).cast("long").alias("copies"), F.lit(None).cast("boolean").alias("first"))
    cell = F.array_sort(F.collect_list(F.when(F.col("present"), one))).alias("rows")
    solved = _whole(short.groupBy("conv_id").agg(cell))
    if long.isEmpty():
        return solved
    dealt = rows.alias("r").join(F.broadcast(long.alias("l")), same, "left_semi").where("present").drop("present")
    return solved.unionByName(_dealt(dealt, block_rows))


def conversations(blocks: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit and the hash of the repaired `role:text`
    lines. A hash of a long conversation streams through one task, block by block."""
    line = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    blocks = blocks.withColumn("lines", F.array_join(line, "\n")).withColumn("some", F.size("repaired") > 0).drop("repaired")
    names = [f.split(":")[0] for f in _FACTS.split(",")]
    one = blocks.where("blocks = 1").select("conv_id", *names, "audit", F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256"))
    many = blocks.where("blocks > 1")
    pieces = F.array_sort(F.collect_list(F.struct("block", "audit")))
    facts = many.groupBy("conv_id").agg(*[F.max(n).alias(n) for n in names], F.array_join(pieces["audit"], "").alias("audit"))
    kind = many.schema["conv_id"].dataType.simpleString()
    hashed = many.select("conv_id", "block", "some", "lines").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    hashed = hashed.mapInArrow(_hashes, f"conv_id {kind}, repaired_sha256 string").alias("h")
    met = facts.alias("f").join(hashed, F.col("f.conv_id").eqNullSafe(F.col("h.conv_id")))
    return one.unionByName(met.select("f.*", "repaired_sha256"))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, begun, state, filled, kind = None, False, hashlib.sha256(), False, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if begun and row["conv_id"] != now:
                yield closed()
                state, filled = hashlib.sha256(), False
            now, begun = row["conv_id"], True
            if row["some"]:
                state.update(((b"\n" if filled else b"") + row["lines"].encode()))
                filled = True
    if begun:
        yield closed()
