"""Vectors from counts: windowed co-occurrence, positive pointwise mutual information, and
the leading eigenvectors of that sparse symmetric matrix by blocked power iteration.

The result follows from the rows alone: pairs are counted exactly, the first guess is a hash
of each token, and the number of tasks decides nothing. Positions of one sequence meet by an
equi-join on (sequence, position), so a long sequence is spread over tasks and no context is lost.
A row of the matrix is a list of token numbers and weights, so a step of the iteration is a
weighted pooling (see `pooling`); the driver only sees products of size x size numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..storage import materialize
from .ordering import global_rank
from .pooling import LOOKUP_BYTES, weighted_sums
from .skew import ROWS_PER_TASK, attach

EXTRA = 8


def position_pairs(positions: DataFrame, key: Sequence[str], pos: str, token: str, window: int) -> DataFrame:
    """`(a, b, n)`: how often b stands within `window` places of a, in both directions.

    `positions` has one row per place of a sequence, places being consecutive whole numbers.
    """
    left = positions.select(*key, F.col(pos).cast("long").alias("_pos"), F.col(token).alias("a"))
    later = F.explode(F.array(*[F.lit(d) for d in range(1, window + 1)]))
    right = positions.select(*key, F.col(pos).cast("long").alias("_at"), F.col(token).alias("b"))
    right = right.select(*key, "_at", "b", later.alias("_by")).select(*key, (F.col("_at") - F.col("_by")).alias("_pos"), "b")
    return _both_ways(left.join(right, [*key, "_pos"]))


def list_pairs(df: DataFrame, tokens: str, window: int) -> DataFrame:
    """As `position_pairs`, for sequences that are the lists of a column; NULL entries are no tokens."""
    around = F.transform(
        tokens, lambda t, i: F.transform(F.slice(tokens, i + 2, window), lambda u: F.struct(t.alias("a"), u.alias("b")))
    )
    return _both_ways(df.select(F.inline(F.flatten(around))))


def _both_ways(pairs: DataFrame) -> DataFrame:
    counted = pairs.where("a IS NOT NULL AND b IS NOT NULL").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(F.struct("a", "b", "n"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    return counted.select(F.inline(sides)).groupBy("a", "b").agg(F.sum("n").alias("n"))


def positive_information(counts: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """`(a, b, n, weight)` of written counts: ln(n N / (n_a n_b)) where that is above 0."""
    sums = counts.groupBy("a").agg(F.sum("n").alias("_sum"), F.count(F.lit(1)).alias("_pairs"))
    sums = materialize(sums, "margins")
    total = sums.agg(F.sum("_sum")).first()[0] or 0
    first = attach(counts, sums, ["a"], "_pairs", rows_per_task=rows_per_task).withColumnRenamed("_sum", "_of_a")
    both = attach(first, sums.withColumnRenamed("a", "b"), ["b"], "_pairs", rows_per_task=rows_per_task)
    ratio = F.col("n") * F.lit(float(total)) / (F.col("_of_a") * F.col("_sum").cast("double"))
    return both.select("a", "b", "n", F.log(ratio).alias("weight")).where("weight > 0")


def gram(x: DataFrame, y: DataFrame | None, size: int) -> np.ndarray:
    """X' X, or X' Y; one size x size matrix per partition reaches the driver's sum."""
    met = x.select(F.col("vector").alias("x"), F.col("vector").alias("y"))
    if y is not None:
        met = x.select("id", F.col("vector").alias("x")).join(y.select("id", F.col("vector").alias("y")), "id")

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            left, right = (batch.column(c).flatten().to_numpy().reshape(-1, size) for c in ("x", "y"))
            total += left.T @ right
        columns = [pa.array(np.arange(size * size), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "part"])

    parts = met.select("x", "y").mapInArrow(product, "cell int, part double")
    found = np.zeros(size * size)
    for row in parts.groupBy("cell").agg(F.sum("part").alias("total")).collect():
        found[row["cell"]] = row["total"]
    return found.reshape(size, size)


def _turned(x: DataFrame, matrix: np.ndarray) -> DataFrame:
    @arrow_udf("array<double>")
    def times(vectors: pa.Array) -> pa.Array:
        rows = vectors.flatten().to_numpy().reshape(-1, len(matrix)) @ matrix
        offsets = pa.array(np.arange(len(rows) + 1) * matrix.shape[1], pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))

    return x.withColumn("vector", times("vector"))


def train_vectors(weights: DataFrame, size: int = 100, rounds: int = 8, limit: int = LOOKUP_BYTES) -> DataFrame:
    """`(token, vector)`: the leading eigenvectors of the weights, each times the root of its
    eigenvalue's size. `EXTRA` more directions are iterated than kept, which speeds convergence.
    With fewer tokens than `size`, vectors are as long as there are tokens."""
    tokens = weights.groupBy(F.col("a").alias("token")).agg(F.count(F.lit(1)).alias("n"))
    tokens = materialize(global_rank(tokens, ["token"], "id", start=1), "tokens")
    count = tokens.count()
    size, kept = min(size + EXTRA, count), min(size, count)
    if not size:
        return tokens.select("token", F.array().cast("array<double>").alias("vector"))
    ids = tokens.select(F.col("token").alias("b"), F.col("id").alias("_b"), "n")
    known = attach(weights.select("a", "b", "weight"), ids, ["b"])
    entries = F.array_sort(F.collect_list(F.struct("_b", "weight")))
    rows = known.groupBy("a").agg(entries.alias("e")).join(tokens.select(F.col("token").alias("a"), "id"), "a")
    # a row has at most one entry per token
    matrix = materialize(rows.select("id", F.col("e._b").alias("ids"), F.col("e.weight").alias("w")), "matrix")
    guess = [F.xxhash64("token", F.lit(d)) / F.lit(float(1 << 63)) for d in range(size)]
    x = materialize(tokens.select("id", F.array(*guess).alias("vector")), "guess")
    for _ in range(rounds):
        y = materialize(weighted_sums(matrix, ["id"], "ids", "w", x, limit), "step")
        x = _orthonormal(y, size)
    # as written, so that the last product meets the same vectors
    x = materialize(x, "basis")
    y = materialize(weighted_sums(matrix, ["id"], "ids", "w", x, limit), "step")
    values, turn = np.linalg.eigh(gram(x, y, size))
    order = np.argsort(-np.abs(values), kind="stable")[:kept]
    scaled = _turned(x, turn[:, order] * np.sqrt(np.abs(values[order])))
    return tokens.select("token", "id").join(scaled, "id").select("token", "vector")


def _orthonormal(y: DataFrame, size: int) -> DataFrame:
    """The same span with orthonormal columns; directions that vanish stay small and no more."""
    values, turn = np.linalg.eigh(gram(y, None, size))
    least = max(values.max(), 1.0) * 1e-24
    return _turned(y, turn / np.sqrt(np.maximum(values, least)))
