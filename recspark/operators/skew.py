"""Joins and running sums that stay balanced when one key holds most of the rows.

A fitted table has one row per key and a column with the number of fact rows of
that key. A key is hot when it has more than `rows_per_task` of them, so there are
at most `rows / rows_per_task` hot keys: that list may always be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize

ROWS_PER_TASK = 4_000_000
SMALL_ROWS = 20_000
SMALL_BYTES = 32 << 20


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]


def attach(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    n: str = "n",
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join `df` to a fitted table with unique keys; the rows of a hot key are split.

    Without hot keys this is a plain equi-join, broadcast by Catalyst when the written
    table is small; rows with a NULL key are spread in any case. A key that is hot in `df`
    alone, not where the table was fitted, is left to the adaptive skew join. With hot keys a table that proves small is broadcast; else the rows of
    a hot key are spread over `ceil(n / rows_per_task)` salts and its one table row is
    repeated as often. The salt is a hash of the row, so a re-run task yields the same.
    """
    on = list(on)
    splits = F.ceil(F.col(n) / F.lit(rows_per_task)).cast("int")
    hot = table.where(F.col(n) > rows_per_task).select(*on, splits.alias("_splits"))
    row = F.xxhash64(*_hashable(df))
    unknown = F.lit(False)
    for key in on:
        unknown = unknown | F.col(key).isNull()
    if hot.isEmpty():
        if how != "left":
            return df.join(table.drop(n), on, how)
        spread = df.withColumn("_salt", F.when(unknown, F.pmod(row, F.lit(4096))).otherwise(0).cast("int"))
        return spread.join(table.drop(n).withColumn("_salt", F.lit(0)), [*on, "_salt"], how).drop("_salt")
    if is_small(table):
        return df.join(F.broadcast(table.drop(n)), on, how)
    # a NULL key matches nothing, so its rows may go anywhere
    salt = F.when(unknown, F.pmod(row, F.lit(4096))).otherwise(
        F.coalesce(F.pmod(row, F.col("_splits")), F.lit(0))
    )
    left = df.join(F.broadcast(hot), on, "left").withColumn("_salt", salt.cast("int"))
    last = F.greatest(F.coalesce(splits, F.lit(1)) - 1, F.lit(0))
    right = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop(n)
    return left.join(right, [*on, "_salt"], how).drop("_salt", "_splits")


def is_small(df: DataFrame) -> bool:
    """Whether a table may be broadcast: few rows, and few bytes when written as JSON."""
    written = F.length(F.to_json(F.struct("*")))
    rows, size = df.limit(SMALL_ROWS + 1).agg(F.count(F.lit(1)), F.sum(written)).first()
    return rows <= SMALL_ROWS and (size or 0) <= SMALL_BYTES


def attach_side(
    df: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`attach` for a side table that was not counted.

    A side that proves small is broadcast; else the hot keys of `df` are found first.
    """
    if is_small(side):
        return df.join(F.broadcast(side), list(on), how)
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    hot = materialize(counts.where(F.col("n") > rows_per_task), "hot")
    if hot.isEmpty():
        return attach(df, side.withColumn("n", F.lit(0)), on, "n", how, rows_per_task)
    # a hot key that the side lacks (a sentinel) gets a row without values, so it is split too
    counted = side.join(hot, list(on), "full" if how == "left" else "left")
    return attach(df, counted.withColumn("n", F.coalesce("n", F.lit(0))), on, "n", how, rows_per_task)


def key_profile(df: DataFrame, on: Sequence[str], *extra: Column) -> DataFrame:
    """Per key: its rows `n`, and what `extra` asks."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"), *extra)


def _same(left: str, right: str, on: Sequence[str]) -> Column:
    """The keys agree; NULL is a key like others."""
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in on])


def segments(
    df: DataFrame, profile: DataFrame, on: Sequence[str], order_by: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> tuple[DataFrame, DataFrame | None]:
    """`df` without the rows of hot keys, and those rows dealt out in order, or None.

    The hot rows are range-partitioned by key and order columns, of whatever kind, and written
    once with the number of their partition as `_segment`. A segment of a key holds about
    `rows_per_task / 2` rows, and all its rows stand before those of the key's next segment, so
    what runs along the order needs one carry per segment. Only rows that agree in all order
    columns cannot be parted.
    """
    hot = profile.where(F.col("n") > rows_per_task).select(*on, "n")
    total = hot.agg(F.sum("n")).first()[0]
    if not total:
        return df, None
    # at most rows / rows_per_task keys
    named, rows = F.broadcast(hot.select(*on)).alias("h"), df.alias("d")
    cold = rows.join(named, _same("d", "h", on), "left_anti")
    parts = -(-2 * total // rows_per_task)
    laid = rows.join(named, _same("d", "h", on), "left_semi").repartitionByRange(parts, *on, *order_by)
    return cold, materialize(laid.withColumn("_segment", F.spark_partition_id()), "segments")


def running_sums(
    df: DataFrame,
    profile: DataFrame,
    on: Sequence[str],
    order_by: Sequence[str],
    sums: dict[str, Column],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Sums over the earlier rows of the same key, in the order of `order_by`.

    `profile` is a written `key_profile` of `df`. The rows of hot keys are summed within their
    segments, and each (segment, key) adds one carry: the total of the segments before it.
    There are at most segments + hot keys of these, so they are broadcast.
    """
    on, order_by = list(on), list(order_by)

    def within(rows: DataFrame, *group: str) -> DataFrame:
        earlier = Window.partitionBy(*on, *group).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select("*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(k) for k, c in sums.items()])

    cold, laid = segments(df, profile, on, order_by, rows_per_task)
    if laid is None:
        return within(cold)
    totals = laid.groupBy(*on, "_segment").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    before = Window.partitionBy(*on).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carries = [F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_c_{k}") for k in sums]
    carry = F.broadcast(totals.select(*on, "_segment", *carries)).alias("c")
    local = within(laid, "_segment").alias("d")
    joined = local.join(carry, _same("d", "c", [*on, "_segment"]))
    summed = joined.select(*[f"d.{c}" for c in df.columns], *[(F.col(f"d.{k}") + F.col(f"c._c_{k}")).alias(k) for k in sums])
    return within(cold).unionByName(summed)
