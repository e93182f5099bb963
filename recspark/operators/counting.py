"""Count and distinct-count encodings, binned before they are joined back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .keys import is_whole, key_fields, key_text, keyed, present
from .scaling import bin_of, quantile_edges
from .skew import ROWS_PER_TASK, attach

DISTINCT_PREFIX = "_hll_"


def fit_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`(feature, number, key, n)`: rows per value of every key column, from one scan."""
    entries = [F.struct(*key_fields(df, k)) for k in keys]
    counts = df.select(F.inline(F.array(*entries))).where(present())
    counts = counts.groupBy("feature", "number", "text").agg(F.count(F.lit(1)).alias("n"))
    shaped = counts.select("feature", "number", key_text().alias("key"), "n")
    return materialize(shaped, "counts", partition_by=["feature"])


def attach_feature(
    df: DataFrame, fitted: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Join the fitted rows of one key column; see `keys` for the shape of `fitted`."""
    left, table = keyed(df, fitted, key)
    return attach(left, table, ["_key"], rows_per_task=rows_per_task).drop("_key")


def count_encode(
    df: DataFrame,
    fitted: DataFrame,
    keys: Sequence[str],
    bins: int | None = 10,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add `<key>_cnt`, the rows of the key, as quantile bin over the rows.

    A key with count c stands for c rows with that count, so the bin edges follow from
    the fitted table and the large table is neither scanned nor sorted for them.
    """
    edges = {}
    if bins:
        weights = fitted.where(F.col("feature").isin(list(keys))).groupBy(
            F.col("feature").alias("feat"), F.col("n").cast("double").alias("x")
        )
        fit = quantile_edges(weights.agg(F.sum("n").alias("n")), dict.fromkeys(keys, bins))
        edges = {r.feat: r.edges for r in fit.collect()}
    for key in keys:
        value = bin_of(F.col("n"), edges[key]) if bins else F.col("n")
        df = attach_feature(df, fitted.withColumn(f"{key}_cnt", value), key, rows_per_task)
    return df


def fit_distinct_counts(df: DataFrame, pairs: dict[str, Sequence[str]]) -> DataFrame:
    """`(feature, number, key, n, <key>_<value>_nunique..)` for all key columns, from one scan.

    Repeats of (key, value) are removed on both sides of a shuffle on that pair, so a hot
    key is spread by its values before its distinct values are counted. Two columns that count
    each other share these pairs, and the counts are moved as one narrow row per key and task.
    """
    names = [(k, v, f"{k}_{v}_nunique") for k, values in pairs.items() for v in values]
    # each pair of a key column has all rows of the key, so the first one counts them
    counting = [i for i, (k, v, _) in enumerate(names) if v == pairs[k][0]]
    whole = all(is_whole(df, c) for k, v, _ in names for c in (k, v))
    kind = "long" if whole else "string"
    # the columns of each group of pairs, and which way each pair reads them
    ways: dict[tuple[str, str], list[tuple[int, bool]]] = {}
    for i, (k, v, _) in enumerate(names):
        ways.setdefault((v, k) if (v, k) in ways else (k, v), []).append((i, (v, k) in ways))
    entries = [
        F.struct(
            F.lit(group).alias("group"),
            F.col(f"`{k}`").cast(kind).alias("a"),
            F.col(f"`{v}`").cast(kind).alias("b"),
        )
        for group, (k, v) in enumerate(ways)
    ]
    both = [group for group, read in enumerate(ways.values()) if any(turned for _, turned in read)]
    used = F.col("a").isNotNull() | (F.col("group").isin(both) & F.col("b").isNotNull())
    distinct = (
        df.select(F.inline(F.array(*entries)))
        .where(used)
        .groupBy("group", "a", "b")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    read = [F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(turned).alias("turned")) for i, turned in own]) for own in ways.values()]
    laid = distinct.select("a", "b", "rows", F.inline(F.get(F.array(*read), F.col("group"))))
    item, value = [F.when(F.col("turned"), F.col(x)).otherwise(F.col(y)) for x, y in (("b", "a"), ("a", "b"))]
    found = (
        laid.select("pair", "rows", item.alias("item"), value.alias("value"))
        .where(F.col("item").isNotNull())
        .groupBy("pair", "item")
        .agg(F.sum("rows").alias("rows"), F.count("value").alias("values"))
    )
    feature = F.element_at(F.array(*[F.lit(k) for k, _, _ in names]), F.col("pair") + 1)
    counted = found.groupBy(feature.alias("feature"), "item").agg(
        F.sum(F.when(F.col("pair").isin(counting), F.col("rows"))).alias("n"),
        *[
            F.sum(F.when(F.col("pair") == i, F.col("values")).otherwise(0)).alias(name)
            for i, (_, _, name) in enumerate(names)
        ],
    )
    shaped = counted.select(
        "feature",
        F.col("item").try_cast("long").alias("number"),
        F.col("item").cast("string").alias("key"),
        "n",
        *[name for _, _, name in names],
    )
    return materialize(shaped, "distinct", partition_by=["feature"])


def fit_distinct_sketches(df: DataFrame, pairs: dict[str, Sequence[str]], bits: int = 12) -> DataFrame:
    """`(feature, number, key, n, _hll_<value>..)`: a sketch of the distinct values per key, which later
    days' sketches can be united with (see `merging`).

    Sketches are filled before the shuffle, so it moves one row per key and task, never the
    distinct pairs. The standard error is about 1.04 / sqrt(2^bits), 1.6 % by default.
    """
    values = list(dict.fromkeys(v for own in pairs.values() for v in own))
    entries = [
        F.struct(*key_fields(df, k), *[(F.col(f"`{v}`") if v in own else F.lit(None)).cast("string").alias(f"v{i}") for i, v in enumerate(values)])
        for k, own in pairs.items()
    ]
    rows = df.select(F.inline(F.array(*entries))).where(present()).groupBy("feature", "number", "text")
    sketches = [F.hll_sketch_agg(f"v{i}", bits).alias(f"{DISTINCT_PREFIX}{v}") for i, v in enumerate(values)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *sketches)
    shaped = found.select("feature", "number", key_text().alias("key"), "n", *[f"{DISTINCT_PREFIX}{v}" for v in values])
    return materialize(shaped, "sketches", partition_by=["feature"])


def sketched_counts(sketches: DataFrame, pairs: dict[str, Sequence[str]]) -> DataFrame:
    """The estimates in the shape of `fit_distinct_counts`, so that `distinct_encode` takes them."""
    counts = [
        F.when(F.col("feature") == k, F.hll_sketch_estimate(f"{DISTINCT_PREFIX}{v}")).alias(f"{k}_{v}_nunique")
        for k, own in pairs.items()
        for v in own
    ]
    return sketches.select("feature", "number", "key", "n", *counts)


def distinct_encode(
    df: DataFrame,
    fitted: DataFrame,
    pairs: dict[str, Sequence[str]],
    bins: dict[str, int] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add `<key>_<value>_nunique` for every pair, binned over the rows if asked."""
    edges = {}
    if bins:
        entries = [
            F.struct(
                F.lit(f"{k}_{v}_nunique").alias("feat"),
                F.when(F.col("feature") == k, F.col(f"{k}_{v}_nunique")).cast("double").alias("x"),
                F.col("n").alias("n"),
            )
            for k, values in pairs.items()
            for v in values
        ]
        weights = fitted.select(F.inline(F.array(*entries))).where(F.col("x").isNotNull())
        weights = weights.groupBy("feat", "x").agg(F.sum("n").alias("n"))
        edges = {r.feat: r.edges for r in quantile_edges(weights, bins).collect()}
    for key, values in pairs.items():
        columns = [f"{key}_{v}_nunique" for v in values]
        shown = [(bin_of(F.col(c), edges[c]) if bins else F.col(c)).alias(c) for c in columns]
        table = fitted.select("feature", "number", "key", "n", *shown)
        df = attach_feature(df, table, key, rows_per_task)
    return df
