"""Category dictionaries: fitted once as `(feature, number, value, code, n)`, then joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize
from .keys import is_whole, key_fields, key_text, keyed, present
from .ordering import global_rank
from .skew import ROWS_PER_TASK, attach, attach_side

MAX_ONE_HOT = 5_000  # columns that one frame may get


def fit_dictionary(
    df: DataFrame, columns: Sequence[str], as_text: bool = False, offset: int = 0
) -> DataFrame:
    """Sorted distinct values of all columns, coded from `offset`, in one scan.

    Numbers sort as numbers unless `as_text`; text sorts by code point. The
    values are counted before the one global sort, which all features share.
    """
    entries = [F.struct(*key_fields(df, name)) for name in columns]
    counts = (
        df.select(F.inline(F.array(*entries)))
        .where(present())
        .groupBy("feature", "number", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("feature", "number", key_text().alias("value"), "n")
    )
    fractions = [c for c in columns if not is_whole(df, c) and isinstance(df.schema[c].dataType, T.NumericType)]
    fraction = F.when(F.col("feature").isin(*fractions), F.col("value").cast("double"))
    counts = counts.withColumn("fraction", fraction)
    order = ["feature", "value"] if as_text else ["feature", "number", "fraction", "value"]
    ranked = global_rank(counts, order, "rank")
    starts = ranked.groupBy("feature").agg(F.min("rank").alias("start"))
    coded = ranked.join(F.broadcast(starts), "feature").select(
        "feature", "number", "value", (F.col("rank") - F.col("start") + offset).alias("code"), "n"
    )
    return materialize(coded, "dictionary", partition_by=["feature"])


def feature_dictionary(dictionary: DataFrame, feature: str) -> DataFrame:
    """`(value, code, n)` of one feature; only its own files are read."""
    return dictionary.where(F.col("feature") == feature).select("value", "code", "n")


def encode(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str],
    unknown: int | None = None,
    into: dict[str, str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Replace the columns by their codes; values not fitted become `unknown`."""
    into = into or {}
    for name in columns:
        target = into.get(name, name)
        renamed = dictionary.withColumnsRenamed({"value": "key", "code": "_code"})
        left, values = keyed(df, renamed, name)
        joined = attach(left, values, ["_key"], rows_per_task=rows_per_task)
        code = F.col("_code")
        if unknown is not None:
            code = F.coalesce(code, F.lit(unknown).cast("long"))
        keep = [c for c in df.columns if c != target]
        joined = joined.select(*keep, code.alias(target))
        order = df.columns if target in df.columns else [*df.columns, target]
        df = joined.select(*order)
    return df


def decode(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str],
    unknown: str = "unknow",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Replace codes by their values; codes without one become `unknown`."""
    order = df.columns
    for name in columns:
        values = feature_dictionary(dictionary, name).select(
            F.col("code").alias(name), F.col("value").alias("_value"), "n"
        )
        joined = attach(df, values, [name], rows_per_task=rows_per_task)
        df = joined.withColumn(name, F.coalesce("_value", F.lit(unknown))).select(*order)
    return df


def one_hot(df: DataFrame, codes: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """Named 0/1 columns `<column>_<code>` for each fitted code; unseen codes give all 0.

    This form has one column per category, so it is for small category sets; use
    `OneHotEncoder` vectors for large ones.
    """
    fitted = dictionary.where(F.col("feature").isin(list(codes))).select("feature", "code")
    names = sorted((r.feature, r.code) for r in fitted.limit(MAX_ONE_HOT + 1).collect())
    if len(names) > MAX_ONE_HOT:
        raise ValueError(f"over {MAX_ONE_HOT} categories; use OneHotEncoder vectors")
    flags = [
        F.coalesce((F.col(c) == code).cast("int"), F.lit(0)).alias(f"{c}_{code}")
        for c, code in names
    ]
    return df.select(*[c for c in df.columns if c not in codes], *flags)


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default: object) -> DataFrame:
    """Left join to a `(key, value)` table with a default for unknown keys."""
    joined = attach_side(df, table.select(key, value), [key])
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))
