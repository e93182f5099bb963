"""Target encodings that do not leak: one fitted table per training set, then joins.

The fitted table has rows `(feature, number, key, n, total)`; the row with feature
`*` covers all training rows and gives the prior.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize
from .counting import attach_feature
from .keys import key_fields, key_text, keyed, present
from .skew import ROWS_PER_TASK, attach, running_sums

_ALL = "*"


def fit_target(train: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Rows and target sum per value of every key, from one scan."""
    whole = [F.lit(_ALL).alias("feature"), F.lit(0).cast("long").alias("number")]
    whole.append(F.lit(None).cast("string").alias("text"))
    entries = [
        F.struct(*fields, F.col(target).alias("y"))
        for fields in [*(key_fields(train, k) for k in keys), whole]
    ]
    sums = (
        train.select(F.inline(F.array(*entries)))
        .where(present())
        .groupBy("feature", "number", "text")
        .agg(
            F.count("y").alias("n"),
            F.sum("y").alias("total"),
        )
        .select("feature", "number", key_text().alias("key"), "n", "total")
    )
    return materialize(sums, "target", partition_by=["feature"])


def prior(fitted: DataFrame) -> float:
    """Mean target over all training rows."""
    row = fitted.where(F.col("feature") == _ALL).select(F.col("total") / F.col("n")).first()
    if row is None:
        raise ValueError("the training table has no rows")
    return row[0]


def _means(fitted: DataFrame, name: str) -> DataFrame:
    return fitted.select("feature", "number", "key", "n", (F.col("total") / F.col("n")).alias(name))


def _filled(df: DataFrame, name: str, value: float) -> DataFrame:
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))


def positive_count_train(
    train: DataFrame, fitted: DataFrame, keys: Sequence[str], target: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """`<key>_<target>_cnt`: the target sum of the key without the row itself."""
    for key in keys:
        table = fitted.select("feature", "number", "key", "n", F.col("total").alias("_total"))
        name = f"{key}_{target}_cnt"
        joined = attach_feature(train, table, key, rows_per_task)
        train = joined.withColumn(name, F.col("_total") - F.col(target)).drop("_total")
    return train


def positive_count_test(
    test: DataFrame, fitted: DataFrame, keys: Sequence[str], target: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The target sum of the key; unseen keys get the mean of the key sums."""
    averages = fitted.groupBy("feature").agg(F.avg("total").alias("mean"))
    fill = {r.feature: r["mean"] for r in averages.collect()}  # one row per key column
    for key in keys:
        name = f"{key}_{target}_cnt"
        table = fitted.select(
            "feature", "number", "key", "n", F.col("total").cast("double").alias(name)
        )
        test = _filled(attach_feature(test, table, key, rows_per_task), name, fill[key])
    return test


def mean_test(
    test: DataFrame, fitted: DataFrame, keys: Sequence[str], target: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """`<key>_<target>_mean` for rows outside the training set; unseen keys get the prior."""
    overall = prior(fitted)
    for key in keys:
        name = f"{key}_{target}_mean"
        joined = attach_feature(test, _means(fitted, name), key, rows_per_task)
        test = _filled(joined, name, overall)
    return test


def smooth_mean(
    df: DataFrame,
    fitted: DataFrame,
    keys: Sequence[str],
    target: str,
    m: float = 300,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Key mean drawn to the prior as by `m` extra rows; for training and test rows alike."""
    overall = prior(fitted)
    for key in keys:
        name = f"{key}_{target}_mean"
        smooth = (F.col("total") + F.lit(m * overall)) / (F.col("n") + F.lit(m))
        table = fitted.select("feature", "number", "key", "n", smooth.alias(name))
        df = _filled(attach_feature(df, table, key, rows_per_task), name, overall)
    return df


def leave_one_out_train(
    train: DataFrame, fitted: DataFrame, keys: Sequence[str], target: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Mean of the other rows of the key; a key with one row gets the prior."""
    overall = prior(fitted)
    for key in keys:
        name = f"{key}_{target}_mean"
        table = fitted.select(
            "feature", "number", "key", "n", F.col("n").alias("_n"), F.col("total").alias("_t")
        )
        joined = attach_feature(train, table, key, rows_per_task)
        others = F.try_divide(F.col("_t") - F.col(target), F.col("_n") - 1)
        train = _filled(joined.withColumn(name, others).drop("_n", "_t"), name, overall)
    return train


def fit_fold_target(train: DataFrame, keys: Sequence[str], target: str, fold: str) -> DataFrame:
    """Rows `(feature, number, key, fold, n, mean)`: the key mean over the other folds."""
    entries = [
        F.struct(*key_fields(train, k), F.col(fold).alias("fold"), F.col(target).alias("y"))
        for k in keys
    ]
    own = (
        train.select(F.inline(F.array(*entries)))
        .where(present())
        .groupBy("feature", "number", "text", "fold")
        .agg(F.count("y").alias("n"), F.sum("y").alias("total"))
    )
    whole = Window.partitionBy("feature", "number", "text")  # one row per fold
    others = F.try_divide(
        F.sum("total").over(whole) - F.col("total"), F.sum("n").over(whole) - F.col("n")
    )
    means = own.select(
        "feature", "number", key_text().alias("key"), "fold", "n", others.alias("mean")
    )
    return materialize(means, "folds", partition_by=["feature"])


def fold_mean_train(
    train: DataFrame,
    fitted: DataFrame,
    fold_fitted: DataFrame,
    keys: Sequence[str],
    target: str,
    fold: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Out-of-fold mean; a key seen in its own fold only gets the prior."""
    overall = prior(fitted)
    for key in keys:
        name = f"{key}_{target}_mean"
        left, table = keyed(train, fold_fitted, key)
        table = table.withColumnsRenamed({"fold": fold, "mean": name})
        joined = attach(left, table, ["_key", fold], rows_per_task=rows_per_task)
        train = _filled(joined.select(*train.columns, name), name, overall)
    return train


def expanding_mean_train(
    train: DataFrame,
    fitted: DataFrame,
    keys: Sequence[str],
    target: str,
    order_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Mean of the earlier rows of the key; the first row of a key gets the prior."""
    overall = prior(fitted)
    for key in keys:
        name = f"{key}_{target}_mean"
        columns = train.columns
        left, table = keyed(train, fitted.drop("total"), key)
        # rows without a key get the prior; they are no group and may be spread
        row = F.pmod(F.xxhash64(*order_by), F.lit(4096)).cast("int")
        left = left.withColumn("_none", F.when(F.col("_key").isNull(), row).otherwise(0))
        table = table.withColumn("_none", F.lit(0))
        sums = {"_n": F.when(F.col(target).isNotNull(), 1).otherwise(0), "_t": F.col(target)}
        summed = running_sums(left, table, ["_key", "_none"], order_by, sums, rows_per_task)
        mean = F.when(F.col("_key").isNotNull(), F.try_divide(F.col("_t"), F.col("_n")))
        train = _filled(summed.withColumn(name, mean).select(*columns, name), name, overall)
    return train
