"""Null fills, casts, recodes and column groups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what a missing entry of each column group becomes
DENSE_FILL = 0
SPARSE_FILL = "-1"
NUMBER_FILL = -1
STRING_FILL = "unknow"


def fill_groups(
    df: DataFrame,
    dense: Sequence[str] = (),
    sparse: Sequence[str] = (),
    numbers: Sequence[str] = (),
    strings: Sequence[str] = (),
) -> DataFrame:
    """Fill each column group with its constant; sparse columns become text."""
    if sparse:
        df = df.withColumns({c: F.col(c).cast("string") for c in sparse})
    fills = dict.fromkeys(dense, DENSE_FILL)
    fills |= dict.fromkeys(sparse, SPARSE_FILL)
    fills |= dict.fromkeys(numbers, NUMBER_FILL)
    fills |= dict.fromkeys(strings, STRING_FILL)
    return df.na.fill(fills) if fills else df


def fit_minima(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the minimum of each column."""
    return df.agg(*[F.min(c).alias(c) for c in columns])


def fit_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of each column."""
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def fill_from(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Fill the columns of a one-row fitted table with its values."""
    values = fitted.first().asDict()
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(fitted.schema[c].dataType)) for c, v in values.items()}
    )


def cast_columns(df: DataFrame, types: dict[str, str], dirty: bool = False) -> DataFrame:
    """Cast the named columns; `dirty` input that cannot be cast becomes NULL."""
    return df.withColumns(
        {c: F.col(c).try_cast(t) if dirty else F.col(c).cast(t) for c, t in types.items()}
    )


def recode(column: Column, codes: dict[object, object]) -> Column:
    """Map listed values; others become NULL."""
    result = F.lit(None)
    for value, code in codes.items():
        result = F.when(column == F.lit(value), F.lit(code)).otherwise(result)
    return result


def equals(column: Column, value: object) -> Column:
    """1 where the column has this value, else 0, also for NULL."""
    return F.coalesce((column == F.lit(value)).cast("int"), F.lit(0))


def label_pairs(df: DataFrame, first: str, second: str, prefix: str = "fl_") -> DataFrame:
    """Four 0/1 columns, one for each combination of two labels."""
    return df.withColumns(
        {
            f"{prefix}{a}{b}": F.when((F.col(first) == a) & (F.col(second) == b), 1).otherwise(0)
            for a in (0, 1)
            for b in (0, 1)
        }
    )


def column_group(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns that exist."""
    return df.select([c for c in names if c in df.columns])


def dense_columns(df: DataFrame, sparse: Iterable[str], labels: Iterable[str]) -> list[str]:
    """All columns that are neither categories nor labels."""
    other = {*sparse, *labels}
    return [c for c in df.columns if c not in other]


def first_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def rearrange(df: DataFrame, renames: dict[str, str], order: Sequence[str]) -> DataFrame:
    """Rename, then keep the listed columns in the listed order."""
    return df.withColumnsRenamed(renames).select(*order)
