"""Resharding by minimum-cost flow: from old shard sizes to new capacities, moving least.

The old shard sizes (a handful of numbers) and the new capacities form a transport problem:
a byte that stays costs nothing, a byte that moves costs one. Successive shortest paths
solve it exactly. Each old shard then keeps its first bytes in a fixed order and hands on
the rest, so the solution is a list of cuts. Documents are ordered from large to small
(quarter octaves of size, then a hash), so a cut falls between small documents and shards
come out nearly equal.

The cut positions become keys of that order: sums of blocks of documents (size class and
leading hash bits) find the block of each cut, and only those blocks are searched row by
row. After that a document's shard follows from its own row and a table of at most
old x new cuts, so texts move once: into range partitions of (shard, order), which are
written as one folder per shard. Slots are places in that layout.

Defined cases: a null text has no bytes and counts its fixed share; rows that repeat doc_id
and text share a key and go to the same shard; null doc_ids are ordinary; an empty table
gives no rows; columns named like the new ones are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize, new_path

OVERHEAD = 16  # bytes that each document counts besides its text
_BLOCK_ROWS = 4096
_ORDER = ["_class", "_hash"]


def fewest_moved(sizes: list[int], capacities: list[int], cost: np.ndarray | None = None) -> np.ndarray:
    """Bytes from each old to each new shard, at the least total cost.

    `cost[a, b]` per byte; by default 0 to stay (a = b) and 1 to move. The capacities must
    hold all bytes.
    """
    supply, room = np.array(sizes, np.int64), np.array(capacities, np.int64)
    if supply.sum() > room.sum():
        raise ValueError("the new shards cannot hold the old ones")
    if cost is None:
        cost = 1 - np.eye(len(supply), len(room), dtype=np.int64)
    flow = np.zeros(cost.shape, np.int64)
    far = np.int64(1) << 40
    while supply.any():
        old = np.where(supply > 0, 0, far)
        new = np.full(len(room), far)
        from_old, from_new = np.full(len(room), -1), np.full(len(supply), -1)
        while True:
            reach = old[:, None] + cost
            best = reach.argmin(0)
            closer = reach[best, np.arange(len(room))] < new
            new[closer], from_old[closer] = reach[best, np.arange(len(room))][closer], best[closer]
            back = np.where(flow > 0, new[None, :] - cost, far)
            best = back.argmin(1)
            nearer = back[np.arange(len(supply)), best] < old
            if not nearer.any():
                break
            old[nearer], from_new[nearer] = back[np.arange(len(supply)), best][nearer], best[nearer]
        end = int(np.where(room > 0, new, far).argmin())
        path, at = [], end
        while True:
            a = int(from_old[at])
            path.append((a, at, 1))
            if from_new[a] < 0:
                break
            at = int(from_new[a])
            path.append((a, at, -1))
        pushed = min(int(supply[a]), int(room[end]), *[int(flow[x, y]) for x, y, way in path if way < 0])
        for x, y, way in path:
            flow[x, y] += way * pushed
        supply[a] -= pushed
        room[end] -= pushed
    return flow


def _described(docs: DataFrame, old: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + OVERHEAD).cast("long")
    return docs.withColumns({
        "_old": old.cast("int"),
        "_size": size,
        "_class": (-F.floor(4 * F.log2(size))).cast("int"),
        "_hash": F.xxhash64("doc_id", F.crc32(text.cast("binary"))),
    })


def _cuts(rows: DataFrame, flow: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """For each old shard its cuts in order: (class, hash, shard before the cut)."""
    spark = rows.sparkSession
    wanted = []
    for a, row in enumerate(flow.tolist()):
        at = 0
        for b in sorted(range(len(row)), key=lambda b: (b != a, b)):
            if row[b]:
                at += row[b]
                wanted.append((a, at, b))
    bits = max(0, int(rows.count() / _BLOCK_ROWS / max(len(flow), 1)).bit_length())
    block = F.shiftright("_hash", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.select("_old", "_size", *_ORDER, block.alias("_block"))
    blocks = rows.groupBy("_old", "_class", "_block").agg(F.sum("_size").alias("n"))
    earlier = Window.partitionBy("_old").orderBy("_class", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    cuts = F.broadcast(spark.createDataFrame(wanted, "_old int, cut long, shard int"))
    inside = blocks.join(cuts, "_old").where((F.col("before") < F.col("cut")) & (F.col("cut") <= F.col("before") + F.col("n")))
    # rows of the blocks that hold a cut; the first whose middle lies beyond begins the next shard
    near = rows.join(F.broadcast(inside.select("_old", "_class", "_block", "before").distinct()), ["_old", "_class", "_block"])
    so_far = Window.partitionBy("_old", "_class", "_block").orderBy("_hash").rangeBetween(Window.unboundedPreceding, -1)
    near = near.groupBy("_old", "_class", "_block", "before", "_hash").agg(F.sum("_size").alias("_size"))
    middle = F.col("before") + F.coalesce(F.sum("_size").over(so_far), F.lit(0)) + F.col("_size") / 2
    near = near.select("_old", "_class", "_block", "_hash", middle.alias("middle"))
    beyond = inside.select("_old", "_class", "_block", "cut", "shard").join(near, ["_old", "_class", "_block"])
    found = beyond.groupBy("_old", "cut", "shard", "_class", "_block").agg(
        F.min(F.when(F.col("middle") >= F.col("cut"), F.col("_hash"))).alias("first"), F.max("_hash").alias("last")
    )
    out: dict[int, list[tuple[int, int, int]]] = {}
    for r in sorted(found.collect(), key=lambda r: (r["_old"], r["cut"])):
        # without a row beyond the cut, the cut lies behind the block's last row
        key = r["first"] if r["first"] is not None else min(r["last"] + 1, (1 << 63) - 1)
        out.setdefault(r["_old"], []).append((r["_class"], key, r["shard"]))
    return out


def _shard(cuts: dict[int, list[tuple[int, int, int]]]) -> Column:
    """The shard of a row: that of the first cut of its old shard behind the row's key."""
    whole = F.lit(None).cast("int")
    for old, rows in cuts.items():
        own = F.lit(rows[-1][2])
        for kind, key, shard in reversed(rows[:-1]):
            before = (F.col("_class") < kind) | ((F.col("_class") == kind) & (F.col("_hash") < F.lit(key)))
            own = F.when(before, shard).otherwise(own)
        whole = F.when(F.col("_old") == old, own).otherwise(whole)
    return whole.cast("int")


def reshard(docs: DataFrame, old: Column, old_shards: int, shards: int) -> tuple[DataFrame, str]:
    """`docs` written into `shards` folders of nearly equal bytes, reread with shard, slot
    (gapless from 0) and moved; and the folder. `old`: the present shard, 0 to old_shards - 1."""
    spark = docs.sparkSession
    names = {c: f"c{i}" for i, c in enumerate(c for c in docs.columns if c not in ("shard", "slot", "moved"))}
    carried = docs.withColumn("_before", old).select(*[F.col(c).alias(n) for c, n in names.items()], "_before")
    carried = carried.withColumns({"doc_id": F.col(names["doc_id"]), "text": F.col(names["text"])})
    rows = _described(carried, F.col("_before")).drop("_before")
    narrow = materialize(rows.select("_old", "_size", *_ORDER), "sizes")
    present = {r["_old"]: r["n"] for r in narrow.groupBy("_old").agg(F.sum("_size").alias("n")).collect()}
    sizes = [present.get(a, 0) for a in range(old_shards)]
    total = sum(sizes)
    flow = fewest_moved(sizes, [total // shards + (b < total % shards) for b in range(shards)])
    cuts = _cuts(narrow, flow)

    order = ["shard", "_old", *_ORDER]
    folder = new_path(spark, "shards")
    placed = rows.withColumn("shard", _shard(cuts)).drop("doc_id", "text", "_size")
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumns({"_place": F.monotonically_increasing_id(), "_part": F.spark_partition_id(), "moved": F.col("shard") != F.col("_old")})
    placed.drop("_old", *_ORDER).write.partitionBy("shard").parquet(folder)
    schema = placed.drop("_old", *_ORDER).schema
    written = spark.read.schema(schema).parquet(folder)
    # a shard's rows are a stretch of consecutive places in each of its partitions
    parts = written.groupBy("shard", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    out = written.join(parts, ["shard", "_part"])
    slot = (F.col("_place") - F.col("_first") + F.col("_base")).cast("long")
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], "shard", slot.alias("slot"), "moved"), folder
