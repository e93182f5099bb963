"""Ranking models on `pyspark.ml`, factorisation-machine scores, batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    FMClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import FMRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType

from ..functions.arrays import sigmoid
from ..functions.vectors import add, as_doubles
from . import pooling
from .cooccurrence import gram
from .encoding import encode, fit_dictionary
from .keys import is_whole
from .skew import ROWS_PER_TASK, attach, attach_side


def assembled(codes: Sequence[str], dense: Sequence[str], output: str = "features") -> list:
    """Stages: one-hot of the codes (unseen gives all 0) and the dense columns, one vector."""
    vectors = [f"{c}_vec" for c in codes]
    stages = []
    if codes:
        stages.append(
            OneHotEncoder(
                inputCols=list(codes), outputCols=vectors, handleInvalid="keep", dropLast=True
            )
        )
    stages.append(VectorAssembler(inputCols=[*vectors, *dense], outputCol=output))
    return stages


def hashed(columns: Sequence[str], dense: Sequence[str], width: int, output: str = "features") -> list:
    """Stages: category columns of any type and size hashed to `width` sparse places (values that
    share a place share a weight; NULL has none), then the dense columns, one vector.

    Nothing is fitted, so no dictionary is built and the model's size is `width` whatever the ids.
    """
    hasher = FeatureHasher(inputCols=list(columns), categoricalCols=list(columns), numFeatures=width, outputCol="_hashed")
    return [hasher, VectorAssembler(inputCols=["_hashed", *dense], outputCol=output)]


def _inputs(codes: Sequence[str], dense: Sequence[str], width: int | None) -> list:
    return hashed(codes, dense, width) if width and codes else assembled(codes, dense)


def linear_model(codes: Sequence[str], dense: Sequence[str], label: str, width: int | None = None, **params) -> Pipeline:
    """One weight per category value, or per hashed place with `width`, and dense column; sigmoid output."""
    return Pipeline(stages=[*_inputs(codes, dense, width), LogisticRegression(labelCol=label, **params)])


def fm_classifier(codes: Sequence[str], dense: Sequence[str], label: str, width: int | None = None, **params) -> Pipeline:
    """Linear plus pairwise factor terms; trained by gradient descent on minibatches."""
    return Pipeline(stages=[*_inputs(codes, dense, width), FMClassifier(labelCol=label, **params)])


def fm_regressor(codes: Sequence[str], dense: Sequence[str], label: str, width: int | None = None, **params) -> Pipeline:
    return Pipeline(stages=[*_inputs(codes, dense, width), FMRegressor(labelCol=label, **params)])


def perceptron(
    codes: Sequence[str], dense: Sequence[str], label: str, hidden: Sequence[int], inputs: int, **params
) -> Pipeline:
    """Dense layers; `pyspark.ml` uses sigmoid hidden units where the reference uses relu."""
    model = MultilayerPerceptronClassifier(labelCol=label, layers=[inputs, *hidden, 2], **params)
    return Pipeline(stages=[*assembled(codes, dense), model])


def probability(df: DataFrame, name: str = "score") -> DataFrame:
    """The probability of label 1 from a classifier's output."""
    return df.withColumn(name, F.get(vector_to_array("probability"), 1))


def factor_vectors(
    df: DataFrame, user: str, item: str, rating: str, rank: int = 32, seed: int = 42, rounds: int = 5
) -> tuple[DataFrame, DataFrame]:
    """One vector per user and per item, by alternating least squares on implicit feedback.

    The solver takes 32-bit ids only, so ids of any size and kind are coded and decoded.
    """
    counted = df.groupBy(user, item).agg(F.sum(rating).cast("float").alias(rating))
    dictionary = fit_dictionary(counted, [user, item])
    counted = encode(counted, dictionary, [user, item])
    counted = counted.withColumns({c: F.col(c).cast("int") for c in (user, item)})
    blocks = max(10, df.sparkSession.sparkContext.defaultParallelism)
    model = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        implicitPrefs=True,
        rank=rank,
        seed=seed,
        maxIter=rounds,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
    ).fit(counted)

    def decoded(factors: DataFrame, name: str) -> DataFrame:
        value = "number" if is_whole(df, name) else "value"
        own = dictionary.where(F.col("feature") == name)
        own = own.select("code", F.col(value).cast(df.schema[name].dataType).alias(name))
        return own.join(factors, F.col("code") == F.col("id")).select(name, F.col("features").alias("vector"))

    return decoded(model.userFactors, user), decoded(model.itemFactors, item)


def fold_in(
    events: DataFrame,
    user: str,
    item: str,
    rating: str,
    items: DataFrame,
    reg: float = 0.1,
    alpha: float = 1.0,
    limit: int = pooling.LOOKUP_BYTES,
) -> DataFrame:
    """`(user, vector)`: vectors of users, also of those who were not trained on, against fixed
    item vectors `(item, vector)`.

    Each user's normal equations of the implicit least squares are summed over its items and
    solved: (Y'Y + sum c y y' + reg n I) x = sum (1 + c) y with c = alpha |rating|, n and the
    right side over ratings above 0. A user of the training with the training's `reg` and `alpha` gets its
    factor again. Users without a known item get no row; item ids are whole numbers.
    """
    counted = events.groupBy(user, item).agg(F.sum(rating).cast("float").cast("double").alias("_r"))
    counted = counted.where(F.col(item).isNotNull() & (F.col("_r") != 0))
    known = items.select(F.col(item).alias("id"), as_doubles(F.col("vector")).alias("vector"))
    size = known.agg(F.max(F.size("vector"))).first()[0]
    kind = events.schema[user].dataType.simpleString()
    if not size:
        return events.sparkSession.createDataFrame([], f"{user} {kind}, vector array<double>")
    base = gram(known.select("vector"), None, size)
    upper = np.triu_indices(size)

    def solved(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> pa.Array:
        full = np.zeros((len(n), size, size))
        full[:, upper[0], upper[1]] = left
        full[:, upper[1], upper[0]] = left
        full += base + reg * n[:, None, None] * np.eye(size)
        x = np.linalg.solve(full, right[:, :, None])[:, :, 0]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * size, pa.int32()), pa.array(x.ravel()))

    def parts(y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = alpha * np.abs(r)[:, None]
        return c * y[:, upper[0]] * y[:, upper[1]], np.where(r[:, None] > 0, 1 + c, 0) * y

    table = pooling.lookup(known, limit=limit)
    if table is not None:
        # a list has at most one entry per known item
        shared = events.sparkSession.sparkContext.broadcast(table)
        lists = counted.groupBy(user).agg(F.collect_list(F.struct(F.col(item).cast("long").alias("i"), "_r")).alias("e"))

        @arrow_udf("array<double>")
        def vectors(ids: pa.Array, ratings: pa.Array) -> pa.Array:
            own, out = shared.value, []
            for first, count, row, found in pooling.batches(ids):
                at, here = own.find(found)
                r = ratings[first : first + count].flatten().to_numpy(zero_copy_only=False)[here]
                row, (left, right) = row[here], parts(own.matrix[at[here]], r)
                n = np.bincount(row[r > 0], minlength=count)
                some = pa.array(np.bincount(row, minlength=count) > 0)
                x = solved(pooling.row_sums(left, row, count), pooling.row_sums(right, row, count), np.maximum(n, 1))
                out.append(pc.if_else(some, x, pa.scalar(None, x.type)))
            return pa.chunked_array(out, pa.list_(pa.float64())).combine_chunks()

        found = lists.select(user, vectors("e.i", "e._r").alias("vector"))
        return found.where("vector IS NOT NULL")

    @arrow_udf("array<double>")
    def terms(ys: pa.Array, ratings: pa.Array) -> pa.Array:
        y, r = ys.flatten().to_numpy().reshape(-1, size), ratings.to_numpy()
        cells = np.concatenate([*parts(y, r), (r > 0)[:, None]], axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1) * cells.shape[1], pa.int32()), pa.array(cells.ravel()))

    @arrow_udf("array<double>")
    def solution(sums: pa.Array) -> pa.Array:
        cells = sums.flatten().to_numpy().reshape(len(sums), -1)
        return solved(cells[:, : len(upper[0])], cells[:, len(upper[0]) : -1], np.maximum(cells[:, -1], 1))

    met = attach_side(counted, known.withColumnRenamed("id", item), [item], how="inner")
    total = vector_to_array(Summarizer.sum(array_to_vector(terms("vector", "_r"))))
    return met.groupBy(user).agg(total.alias("s")).select(user, solution("s").alias("vector"))


def pair_interaction(vectors: Sequence[Column]) -> Column:
    """0.5 * sum((sum v)^2 - sum v^2): all pairwise dot products in linear time."""
    total = vectors[0]
    for vector in vectors[1:]:
        total = add(total, vector)

    def energy(v: Column) -> Column:
        return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)

    own = energy(vectors[0])
    for vector in vectors[1:]:
        own = own + energy(vector)
    return F.lit(0.5) * (energy(total) - own)


def fm_score(
    df: DataFrame,
    fields: Sequence[str],
    table: DataFrame,
    linear: Column,
    name: str = "score",
    pooled: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Factorisation-machine probability from an embedding table `(feature, id, vector, n)`.

    Each field is one join on its id; `pooled` names columns that already hold a vector.
    """
    columns = df.columns
    vectors = [F.col(c).cast("array<double>") for c in pooled]
    for field in fields:
        own = table.where(F.col("feature") == field).select(
            F.col("id").alias(field), F.col("vector").cast("array<double>").alias(f"_v_{field}"), "n"
        )
        df = attach(df, own, [field], rows_per_task=rows_per_task)
        vectors.append(F.col(f"_v_{field}"))
    return df.select(*columns, sigmoid(linear + pair_interaction(vectors)).alias(name))


def batch_score(
    df: DataFrame,
    inputs: Sequence[Column],
    make_predict: Callable[[], Callable[..., np.ndarray]],
    name: str = "pred_scores",
    batch_size: int = 4096,
) -> DataFrame:
    """Attach the scores of an external model; it is loaded once per worker, fed in batches."""
    predict = predict_batch_udf(make_predict, return_type=DoubleType(), batch_size=batch_size)
    return df.withColumn(name, predict(*inputs))


def ranking_rows(
    candidates: DataFrame, user: str, users: DataFrame, item: str, items: DataFrame
) -> DataFrame:
    """Recalled `(user, item)` rows with the features of both sides: the ranking input."""
    return attach_side(attach_side(candidates, users, [user]), items, [item])


def ranked_list(df: DataFrame, user: str, score: str, tie: str) -> DataFrame:
    """All rows, by user, best score first."""
    return df.orderBy(user, F.desc(score), tie)


def mean_prediction(runs: Sequence[DataFrame], key: Sequence[str], score: str) -> DataFrame:
    """Mean score per row key over repeated predictions."""
    stacked = runs[0]
    for run in runs[1:]:
        stacked = stacked.unionByName(run)
    return stacked.groupBy(*key).agg(F.avg(score).alias(score))
