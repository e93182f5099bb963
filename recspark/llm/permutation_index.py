"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots (`prefix` of them). Each block of
the index posts its vectors in one inverted file per pivot, as (vector, place of the pivot).
A query walks the files of its own nearest pivots and adds up, for each vector met,
2 min(prefix - own place, prefix - its place), which is a constant minus the footrule
distance of the two orders (a missing pivot counts as place `prefix`). The `share` of the
block with the smallest footrule distance is reranked by the exact measure on the original
vectors, and only the nearest of a block leave it.

Every row is indexed; pivots are a documented sample of `pivots` distinct vectors (smallest
hashes). Blocks are dealt by a hash of the vector and hold at most `block_rows` of them on
average, and queries pass over them in blocks of about `query_rows`, which bounds both
memory and broadcasts. Equal vectors are collapsed beforehand to the few smallest ids that
can appear in a result, so a vector that a third of the rows share is one entry.

Measured against brute force, recall is in the README.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null
or non-finite components take no part, nor do rows without id; rows that repeat a query's id
are its own; fewer than k candidates give fewer rows; ties go to the smaller id; other
columns are not carried.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize

PIVOTS = 256
PREFIX = 64
SHARE = 0.15
LEAST = 256  # candidates reranked in a block, at least


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    numbers = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    numbers = numbers.where(F.col("vec_id").isNotNull() & fine & some)
    length = numbers.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return numbers.where(F.size("embedding") == (length["d"] if length else 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = len(column)
    return np.asarray(column.flatten(), np.float64).reshape(rows, -1) if rows else np.zeros((0, 0))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(1, keepdims=True))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector in order."""
    return np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :prefix]


def block_search(vectors: np.ndarray, ids: list[list[int]], queries: np.ndarray, query_ids: np.ndarray, pivots: np.ndarray, k: int, prefix: int, share: float):
    """Rows (query, vec_id, score): the k nearest found of this block for each query."""
    prefix = min(prefix, len(pivots))
    order = nearest_pivots(vectors, pivots, prefix)
    pivot = order.ravel()
    by = np.argsort(pivot, kind="stable")
    posted = by // prefix
    weight = prefix - by % prefix
    files = np.searchsorted(pivot[by], np.arange(len(pivots) + 1))
    wanted = min(len(vectors), max(LEAST, int(np.ceil(share * len(vectors)))))
    lengths = np.sqrt((vectors**2).sum(1))
    out: list[tuple[int, int, float]] = []
    for query, own, near in zip(queries, query_ids.tolist(), nearest_pivots(queries, pivots, prefix)):
        met = np.zeros(len(vectors), np.int32)
        for place, p in enumerate(near.tolist()):
            low, high = files[p], files[p + 1]
            met[posted[low:high]] += np.minimum(weight[low:high], prefix - place)
        chosen = np.argpartition(-met, wanted - 1)[:wanted] if wanted < len(vectors) else np.arange(len(vectors))
        score = (vectors[chosen] * query).sum(1) / (lengths[chosen] * np.sqrt((query**2).sum()))
        edge = np.partition(score, -min(k + 1, len(score)))[-min(k + 1, len(score))]
        best = np.flatnonzero(score >= edge)
        rows = [(-float(score[i]), v) for i in best for v in ids[chosen[i]] if v != own]
        out += [(own, v, -s) for s, v in sorted(rows)[:k]]
    return out


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = SHARE,
    block_rows: int = 16_384,
    query_rows: int = 1_024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query by cosine."""
    context = vectors.sparkSession.sparkContext
    rows = materialize(usable(vectors), "vectors")
    # a query needs k others, so k + 1 ids stand for any number of equal vectors
    same = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.distinct().withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    entries = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(entries.withColumn("_hash", F.xxhash64("embedding")), "distinct-vectors")
    count = entries.count()
    blocks = max(context.defaultParallelism, -(-count // block_rows))
    sample = _matrix(entries.orderBy("_hash", "embedding").limit(pivots).select("embedding").toArrow()["embedding"])
    chosen = context.broadcast(_unit(sample) if len(sample) else sample)

    asked = rows.where(is_query).distinct()
    query_blocks = max(1, -(-asked.count() // query_rows))
    index = entries.select("ids", "embedding", F.pmod("_hash", F.lit(blocks)).alias("block"))

    def found(number: int) -> DataFrame:
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)) == number).toArrow()
        block = context.broadcast((_matrix(own["embedding"]), own["vec_id"].to_numpy()))

        def look(table: pa.Table) -> pa.Table:
            queries, query_ids = block.value
            found = block_search(_matrix(table["embedding"]), table["ids"].to_pylist(), queries, query_ids, chosen.value, k, prefix, share)
            columns = list(zip(*found)) or [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "score"])

        return index.groupBy("block").applyInArrow(look, "query_id long, vec_id long, score double")

    near = reduce(DataFrame.unionByName, [found(b) for b in range(query_blocks)])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
