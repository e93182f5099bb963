"""Counts, null and overlap profiles, first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, name: str = "num") -> DataFrame:
    """Rows per value, NULL not counted; sort the result by `name` for a report."""
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def frequent_values(df: DataFrame, column: str, min_count: int, name: str = "num") -> DataFrame:
    """Values with strictly more than `min_count` rows."""
    return value_counts(df, column, name).where(F.col(name) > min_count)


def share_of(df: DataFrame, condition: Column, name: str = "share") -> DataFrame:
    """Share of the rows for which the condition holds."""
    return df.agg(F.avg(F.when(condition, 1.0).otherwise(0.0)).alias(name))


def null_profile(df: DataFrame) -> DataFrame:
    """One row: NULLs per column, from one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def group_mean(df: DataFrame, by: str, column: str, name: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(column).alias(name))


def key_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """One row: distinct keys per side, size of the intersection, least and greatest keys."""
    sides = left.select(F.col(left_key).alias("key"), F.lit(1).alias("l"), F.lit(0).alias("r"))
    sides = sides.unionAll(right.select(F.col(right_key), F.lit(0), F.lit(1)))
    keys = sides.where(F.col("key").isNotNull()).groupBy("key")
    keys = keys.agg(F.max("l").alias("l"), F.max("r").alias("r"))
    in_left, in_right = F.col("l") == 1, F.col("r") == 1
    return keys.agg(
        F.count_if(in_left).alias("left_keys"),
        F.count_if(in_right).alias("right_keys"),
        F.count_if(in_left & in_right).alias("common_keys"),
        F.min(F.when(in_left, F.col("key"))).alias("left_min"),
        F.max(F.when(in_left, F.col("key"))).alias("left_max"),
        F.min(F.when(in_right, F.col("key"))).alias("right_min"),
        F.max(F.when(in_right, F.col("key"))).alias("right_max"),
    )


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key. Spark keeps one row per key before the shuffle already."""
    first = Window.partitionBy(*key).orderBy(*order_by)
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def cardinalities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: distinct values, the same plus one, and greatest value plus one."""
    counts = df.agg(
        *[F.count_distinct(c).alias(f"d_{c}") for c in columns],
        *[F.max(F.col(c).try_cast("long")).alias(f"m_{c}") for c in columns],
    )
    entries = [
        F.struct(
            F.lit(c).alias("feat"),
            F.col(f"d_{c}").alias("nunique"),
            (F.col(f"d_{c}") + 1).alias("nunique_plus_1"),
            (F.col(f"m_{c}") + 1).alias("max_plus_1"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))
