"""Keys of several columns in one table: whole numbers stay numbers, others are text.

A fitted table has `feature`, `number` and `key`: `key` is the value as text, `number`
is set when the column was a whole number, so joins need not compare text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)


def key_fields(df: DataFrame, name: str) -> list[Column]:
    """`feature`, `number`, `text` of one key column; only one of the last two is set."""
    whole = is_whole(df, name)
    column = F.col(f"`{name}`")
    number = column.cast("long") if whole else F.lit(None).cast("long")
    text = F.lit(None).cast("string") if whole else column.cast("string")
    return [F.lit(name).alias("feature"), number.alias("number"), text.alias("text")]


def key_text() -> Column:
    return F.coalesce("text", F.col("number").cast("string"))


def present() -> Column:
    return F.col("number").isNotNull() | F.col("text").isNotNull()


def keyed(df: DataFrame, fitted: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """`df` and the fitted rows of one key column, both with the join column `_key`."""
    own = fitted.where(F.col("feature") == name).drop("feature")
    column = F.col(f"`{name}`")
    if is_whole(df, name):
        own = own.drop("key").withColumnRenamed("number", "_key")
        return df.withColumn("_key", column.cast("long")), own
    own = own.drop("number").withColumnRenamed("key", "_key")
    return df.withColumn("_key", column.cast("string")), own
