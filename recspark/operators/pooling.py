"""Pooling of id lists over a vector table: mean, masked, weighted and attended vectors.

A vector table that proves small (rows x numbers within `LOOKUP_BYTES`) becomes one sorted
matrix, broadcast once; the lists of a batch are then gathered and reduced by row, so no vector
crosses a shuffle and no list is exploded. A larger table is joined by id, and the sums of a
row are reduced where its positions meet their vectors, before the shuffle to the row.

Id 0 is padding. An id without a vector counts as absent. Rows are told apart by `key`, which is
unique. NULL or empty lists give NULL vectors; columns named like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..functions.vectors import as_doubles, dot
from ..storage import materialize
from .skew import attach_side

LOOKUP_BYTES = 64 << 20
POSITIONS = 1 << 16
_PADDING_SCORE = -4294967295.0


@dataclass(frozen=True)
class Lookup:
    """Vectors of sorted ids, one row each."""

    ids: np.ndarray
    matrix: np.ndarray

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each id, and whether it has one."""
        if not len(self.ids):
            return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return at, self.ids[at] == ids


def lookup(vectors: DataFrame, item: str = "id", vector: str = "vector", limit: int = LOOKUP_BYTES) -> Lookup | None:
    """The table as a matrix, or None when it is larger than `limit` bytes. Ids are whole
    numbers and unique; rows with a NULL in them are left out."""
    known = vectors.where(F.col(item).isNotNull() & F.col(vector).isNotNull())
    rows, size = known.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
    if rows * ((size or 0) + 1) * 8 > limit:
        return None
    table = known.select(F.col(item).cast("long").alias("id"), as_doubles(F.col(vector)).alias("v")).toArrow()
    ids = table["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    matrix = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) if rows else np.zeros((0, 0))
    return Lookup(ids[order], matrix[order])


def row_sums(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sums by row of values whose rows are in order."""
    out = np.zeros((rows, *values.shape[1:]))
    if len(row):
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        out[row[first]] = np.add.reduceat(values, first, axis=0)
    return out


def batches(lists: pa.Array):
    """(first row, rows, row of each position, ids) of about `POSITIONS` positions each."""
    sizes = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at] - sizes[at]
        end = max(int(np.searchsorted(ends, base + POSITIONS, "right")), at + 1)
        ids = lists[at:end].flatten().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        yield at, end - at, np.repeat(np.arange(end - at), sizes[at:end]), ids
        at = end


def _vectors(found: list[np.ndarray], present: list[np.ndarray]) -> pa.Array:
    """Rows of a matrix as lists; NULL where not present."""
    if not found:
        return pa.array([], pa.list_(pa.float64()))
    values, keep = np.concatenate(found), np.concatenate(present)
    offsets = np.concatenate(([0], np.cumsum(np.where(keep, values.shape[1], 0))))
    mask = pa.array(np.append(~keep, False))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=mask.to_numpy(zero_copy_only=False)), pa.array(values[keep].ravel()))


def _softmax(scores: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    top = np.full(rows, -np.inf)
    np.maximum.at(top, row, scores)
    power = np.exp(scores - top[row])
    return power / row_sums(power, row, rows)[row]


def pooled_lists(
    rows: DataFrame,
    key: Sequence[str],
    ids: str,
    vectors: DataFrame,
    weight: str | None = None,
    normalize: bool = True,
    limit: int = LOOKUP_BYTES,
) -> DataFrame:
    """Add `mean` over all positions, `masked_mean` over those with an id other than 0, and with
    `weight`, a list of numbers beside `ids`, `weighted_mean`: the masked mean of the vectors
    times their weights, after a softmax over the row's real positions unless `normalize` is off.

    `vectors` is `(id, vector)`.
    """
    table = lookup(vectors, limit=limit)
    if table is None:
        return _pooled_by_join(rows, key, ids, vectors, weight, normalize)
    shared = rows.sparkSession.sparkContext.broadcast(table)
    fields = ["mean", "masked_mean", *(["weighted_mean"] if weight else [])]
    kind = "struct<" + ",".join(f"{f}:array<double>" for f in fields) + ">"

    def pooled(lists: pa.Array, weights: pa.Array | None) -> pa.Array:
        own = shared.value
        sums: list[list[np.ndarray]] = [[] for _ in fields]
        some: list[list[np.ndarray]] = [[] for _ in fields]
        for first, count, row, found in batches(lists):
            at, known = own.find(found)
            parts = [np.ones(known.sum(), bool), found[known] != 0]
            if weights is not None:
                share = weights[first : first + count].flatten().fill_null(0).to_numpy(zero_copy_only=False)[known]
            row, values = row[known], own.matrix[at[known]]
            real = parts[1]
            for i, keep in enumerate([*parts, real][: len(fields)]):
                mine, own_rows = values[keep], row[keep]
                if i == 2:
                    mine = mine * (_softmax(share[keep], own_rows, count) if normalize else share[keep])[:, None]
                n = np.bincount(own_rows, minlength=count)
                sums[i].append(row_sums(mine, own_rows, count) / np.maximum(n, 1)[:, None])
                some[i].append(n > 0)
        return pa.StructArray.from_arrays([_vectors(s, k) for s, k in zip(sums, some)], fields)

    if weight:

        @arrow_udf(kind)
        def described(lists: pa.Array, weights: pa.Array) -> pa.Array:
            return pooled(lists, weights)

        found = described(ids, F.col(weight).cast("array<double>"))
    else:

        @arrow_udf(kind)
        def described(lists: pa.Array) -> pa.Array:
            return pooled(lists, None)

        found = described(ids)
    return rows.withColumn("_pooled", found).withColumns({f: F.col("_pooled")[f] for f in fields}).drop("_pooled")


def attended_lists(rows: DataFrame, key: Sequence[str], ids: str, target: str, vectors: DataFrame, limit: int = LOOKUP_BYTES) -> DataFrame:
    """Add `weights`, the softmax of the dot products of the target's vector with those of the
    list (padding gets none, but a row of padding only weighs all equally), and `vector`, the
    sum by these weights. A target without a vector gives NULLs."""
    table = lookup(vectors, limit=limit)
    if table is None:
        return _attended_by_join(rows, key, ids, target, vectors)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    @arrow_udf("struct<weights:array<double>,vector:array<double>>")
    def attended(lists: pa.Array, targets: pa.Array) -> pa.Array:
        own = shared.value
        wanted, asked = own.find(targets.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64))
        asked &= ~targets.is_null().to_numpy(zero_copy_only=False)
        shares, sizes, sums, some = [], [], [], []
        for first, count, row, found in batches(lists):
            at, known = own.find(found)
            known &= asked[first : first + count][row]
            row, values, found = row[known], own.matrix[at[known]], found[known]
            query = own.matrix[wanted[first : first + count][row]]
            scores = np.where(found != 0, np.einsum("ij,ij->i", query, values), _PADDING_SCORE)
            share = _softmax(scores, row, count)
            shares.append(share)
            sizes.append(np.bincount(row, minlength=count))
            sums.append(row_sums(values * share[:, None], row, count))
            some.append(sizes[-1] > 0)
        if not sizes:
            return pa.StructArray.from_arrays([_vectors([], []), _vectors([], [])], ["weights", "vector"])
        offsets, keep = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), np.concatenate(some)
        mask = np.append(~keep, False)
        weights = pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=mask), pa.array(np.concatenate(shares)))
        return pa.StructArray.from_arrays([weights, _vectors(sums, some)], ["weights", "vector"])

    found = rows.withColumn("_attended", attended(ids, F.col(target).cast("long")))
    return found.withColumns({f: F.col("_attended")[f] for f in ("weights", "vector")}).drop("_attended")


def weighted_sums(rows: DataFrame, key: Sequence[str], ids: str, weight: str, vectors: DataFrame, limit: int = LOOKUP_BYTES) -> DataFrame:
    """`(key.., vector)`: the sum of the vectors of a list times the weights beside it; a row
    without any vector has NULL. As id 0 is padding elsewhere, so it is here."""
    table = lookup(vectors, limit=limit)
    if table is None:
        cells = _met(rows, key, ids, vectors, F.col(weight).alias("_w"))
        cells = cells.withColumn("_w", F.get("_w", F.col("_pos")))
        sums = _sums(cells, key, F.col("_w"), F.col("_id") != 0, "vector").drop("_n")
        return rows.select(*key).join(sums, list(key), "left")
    shared = rows.sparkSession.sparkContext.broadcast(table)

    @arrow_udf("array<double>")
    def summed(lists: pa.Array, weights: pa.Array) -> pa.Array:
        own, sums, some = shared.value, [], []
        for first, count, row, found in batches(lists):
            at, known = own.find(found)
            known &= found != 0
            share = weights[first : first + count].flatten().to_numpy(zero_copy_only=False)[known]
            sums.append(row_sums(own.matrix[at[known]] * share[:, None], row[known], count))
            some.append(np.bincount(row[known], minlength=count) > 0)
        return _vectors(sums, some)

    return rows.select(*key, summed(ids, F.col(weight).cast("array<double>")).alias("vector"))


def _met(rows: DataFrame, key: Sequence[str], ids: str, vectors: DataFrame, *extra: Column) -> DataFrame:
    """`(key.., _pos, _id, _v, extra..)` of positions whose id has a vector."""
    cells = rows.select(*key, F.posexplode(ids).alias("_pos", "_id"), *extra).withColumn("_id", F.coalesce("_id", F.lit(0)))
    known = vectors.select(F.col("id").alias("_id"), as_doubles(F.col("vector")).alias("_v")).where("_id IS NOT NULL AND _v IS NOT NULL")
    return attach_side(cells, known, ["_id"], how="inner")


def _sums(cells: DataFrame, key: Sequence[str], share: Column, keep: Column, name: str) -> DataFrame:
    """Sum of `share * _v` and the number of cells kept, reduced before the shuffle."""
    kept = cells.where(keep).groupBy(*key)
    total = vector_to_array(Summarizer.sum(array_to_vector(F.transform("_v", lambda x: x * share))))
    return kept.agg(total.alias(name), F.count(F.lit(1)).alias("_n"))


def _pooled_by_join(rows, key, ids, vectors, weight, normalize):
    key = list(key)
    carried = [F.col(weight).cast("array<double>").alias("_w")] if weight else []
    cells = _met(rows, key, ids, vectors, *carried)
    real = F.col("_id") != 0
    if weight:
        cells = cells.withColumn("_w", F.coalesce(F.get("_w", F.col("_pos")), F.lit(0.0)))
    wanted = [("mean", F.lit(1.0), F.lit(True)), ("masked_mean", F.lit(1.0), real)]
    out = rows.drop("mean", "masked_mean", *(["weighted_mean"] if weight else []))
    if weight and normalize:
        scored = cells.where(real)
        tops = scored.groupBy(*key).agg(F.max("_w").alias("_top"))
        totals = scored.join(tops, key).groupBy(*key).agg(F.sum(F.exp(F.col("_w") - F.col("_top"))).alias("_all"), F.first("_top").alias("_top"))
        cells = cells.join(materialize(totals, "softmax"), key, "left")
        wanted.append(("weighted_mean", F.exp(F.col("_w") - F.col("_top")) / F.col("_all"), real))
    elif weight:
        wanted.append(("weighted_mean", F.col("_w"), real))
    for name, share, keep in wanted:
        sums = _sums(cells, key, share, keep, name)
        mean = F.transform(name, lambda x: x / F.col("_n"))
        out = out.join(sums.select(*key, mean.alias(name)), key, "left")
    return out


def _attended_by_join(rows, key, ids, target, vectors):
    key = list(key)
    targets = vectors.select(F.col("id").alias("_target"), as_doubles(F.col("vector")).alias("_q")).where("_target IS NOT NULL")
    asked = attach_side(rows.select(*key, ids, F.col(target).alias("_target")), targets, ["_target"], how="inner")
    cells = _met(asked, key, ids, vectors, F.col("_q"))
    score = F.when(F.col("_id") != 0, dot(F.col("_q"), F.col("_v"))).otherwise(_PADDING_SCORE)
    cells = cells.withColumn("_s", score).drop("_q")
    # scores only, without vectors
    entries = F.array_sort(F.collect_list(F.struct("_pos", "_s")))
    listed = cells.groupBy(*key).agg(entries.alias("_e"))
    power = F.transform("_e", lambda e: F.exp(e["_s"] - F.array_max(F.transform("_e", lambda x: x["_s"]))))
    total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
    listed = listed.withColumn("_p", power).select(*key, "_e", F.transform("_p", lambda x: x / total).alias("weights"))
    listed = materialize(listed, "weights")
    single = listed.select(*key, F.explode(F.arrays_zip(F.col("_e._pos").alias("_pos"), F.col("weights").alias("_share"))).alias("_c"))
    cells = cells.join(single.select(*key, F.col("_c._pos").alias("_pos"), F.col("_c._share").alias("_share")), [*key, "_pos"])
    sums = _sums(cells, key, F.col("_share"), F.lit(True), "vector").drop("_n")
    return rows.drop("weights", "vector").join(listed.drop("_e"), key, "left").join(sums, key, "left")
