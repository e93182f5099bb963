"""Splits and shuffles that give the same rows on every run."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import row_at
from .skew import ROWS_PER_TASK

_DRAWS = 1 << 31


def draw(keys: Sequence[str], seed: int, size: int = _DRAWS) -> Column:
    """A pseudo-random whole number in [0, size) fixed by the keys and the seed."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(size))


def fraction_split(
    df: DataFrame, fractions: Sequence[float], number: Column, size: int = _DRAWS
) -> list[DataFrame]:
    """Parts with about the given shares; `number` in [0, size) decides, no shuffle.

    Rows without a number count as 0, so every row is in one part.
    """
    number = F.coalesce(number, F.lit(0))
    parts, low = [], 0
    for share in fractions[:-1]:
        high = low + round(share * size)
        parts.append(df.where((number >= low) & (number < high)))
        low = high
    return [*parts, df.where(number >= low)]


def ordered_split(
    df: DataFrame, order: str, tie: str, held_out: float
) -> tuple[DataFrame, DataFrame]:
    """The first `int(rows * (1 - held_out))` rows in order, and the others.

    The boundary row is found from counts per value slice; nothing is sorted or shuffled.
    Rows without order or tie stand first, and all of them are in the first part.
    """
    unplaced = F.col(order).isNull() | F.col(tie).isNull()
    found = row_at(df, order, tie, lambda placed, rows: int(rows * (1 - held_out)) - 1 - (rows - placed))
    if found is None:
        return df.where(unplaced), df.where(~unplaced)
    at, id_at = found
    early = unplaced | (F.col(order) < at) | ((F.col(order) == at) & (F.col(tie) <= id_at))
    return df.where(early), df.where(~early)


def stratified_folds(
    df: DataFrame,
    label: str,
    key: str,
    number: Column,
    folds: int = 5,
    size: int = _DRAWS,
    name: str = "fold",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add a fold id; within each label the folds differ by at most one row.

    Rows are placed by `number` in [0, size), then `key`. There may be few labels, so the
    number range is cut into blocks: a window per (label, block), plus the rows of the
    label in the blocks before. NULL is a label like the others; a NULL number counts as 0.
    """
    blocks = max(1, math.ceil(df.count() / rows_per_task))
    cut = df.withColumn("_draw", F.coalesce(number, F.lit(0)))
    cut = cut.withColumn("_block", F.floor(F.col("_draw") * blocks / size).cast("int"))
    counts = cut.groupBy(label, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(label).orderBy("_block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(label).alias("_label"),
        F.col("_block").alias("_of"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy(label, "_block").orderBy("_draw", key)) - 1
    same = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_block") == F.col("_of"))
    placed = cut.withColumn("_place", place).join(offsets, same)
    fold = ((F.col("_before") + F.col("_place")) % folds).cast("int").alias(name)
    return placed.select(*df.columns, fold)


def shuffled(df: DataFrame, number: Column, key: str) -> DataFrame:
    """All rows in the order of a fixed pseudo-random number."""
    return df.orderBy(number, key)
