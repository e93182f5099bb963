"""Places in one global order, without ever bringing all rows to one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above 33 local bits


def _laid_out(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Range-partitioned, sorted and written: the sampled range bounds must not move."""
    return materialize(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _LOCAL_BITS)),
        "ordered",
    )


def _offsets(laid: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Sums of all earlier range partitions: one row per partition, so one task may scan it."""
    totals = laid.groupBy("_part").agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_part", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(k) for k in sums]
    )


def global_rank(
    df: DataFrame, order_by: Sequence[str | Column], name: str, start: int = 0
) -> DataFrame:
    """Add the place of each row in the global order, counted from `start`."""
    laid = _laid_out(df, order_by)
    offsets = _offsets(laid, {"_before": F.lit(1)})
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    rank = (F.col("_before") + local + start).alias(name)
    return laid.join(F.broadcast(offsets), "_part").select(*df.columns, rank)


def cumulative(
    df: DataFrame, order_by: Sequence[str | Column], sums: dict[str, Column]
) -> DataFrame:
    """Add, for each sum, its total over all rows before this one in the global order."""
    laid = _laid_out(df, order_by)
    offsets = _offsets(laid, {f"_o_{k}": c for k, c in sums.items()})
    earlier = Window.partitionBy("_part").orderBy("_place")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    inside = laid.select(
        "*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(k) for k, c in sums.items()]
    )
    return inside.join(F.broadcast(offsets), "_part").select(
        *df.columns, *[(F.col(k) + F.col(f"_o_{k}")).alias(k) for k in sums]
    )


def row_at(
    df: DataFrame,
    order: str,
    tie: str,
    place_of: Callable[[int, int], int],
    bins: int = 1024,
    small: int = 100_000,
) -> tuple[int, int] | None:
    """`(order, tie)` of the row at a 0-based place; both columns are whole numbers.

    `place_of` gives the place from the number of rows with both, and of all rows; below 0
    there is no such row.
    Each pass counts the rows in `bins` equal slices of the remaining value range and
    keeps the slice that holds the place, until few rows are left. Only the counts and
    the single row found come to the driver.
    """
    place = None
    known = F.col(order).isNotNull() & F.col(tie).isNotNull()
    for column in (order, tie):
        own = F.when(known, F.col(column))
        low, high, rows, total = df.agg(F.min(own), F.max(own), F.count_if(known), F.count(F.lit(1))).first()
        if place is None:
            place = place_of(rows, total)
            if place < 0:
                return None
            df = df.where(known)
        while low < high and rows > small:
            step = (high - low) // bins + 1
            slices = (
                df.where(F.col(column).between(low, high))
                .groupBy(F.expr(f"(`{column}` - {low}L) div {step}L").alias("slice"))
                .count()
                .orderBy("slice")
                .collect()
            )
            for number, rows in slices:
                if place < rows:
                    break
                place -= rows
            low, high = low + number * step, min(high, low + (number + 1) * step - 1)
        df = df.where(F.col(column).between(low, high))
        if low < high:
            found = df.select(order, tie).orderBy(order, tie).offset(place).limit(1).first()
            return found[0], found[1]
    return df.select(order, tie).first()
