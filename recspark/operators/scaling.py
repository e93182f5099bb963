"""Scaling and quantile bins. Each fit is one small table, each transform an expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import cumulative


def fit_standard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows `(feat, mean, std)`: population deviation, NULL counted as 0, one scan."""
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in columns}
    row = df.agg(
        *[F.avg(v).alias(f"a_{c}") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"b_{c}") for c, v in filled.items()],
    )
    return _per_feature(row, columns, "mean", "std")


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows `(feat, low, high)`, one scan."""
    row = df.agg(
        *[F.min(c).cast("double").alias(f"a_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"b_{c}") for c in columns],
    )
    return _per_feature(row, columns, "low", "high")


def _per_feature(row: DataFrame, columns: Sequence[str], a: str, b: str) -> DataFrame:
    entries = [
        F.struct(F.lit(c).alias("feat"), F.col(f"a_{c}").alias(a), F.col(f"b_{c}").alias(b))
        for c in columns
    ]
    return row.select(F.inline(F.array(*entries)))


def standard_scale(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Mean 0 and deviation 1; a constant column is only centred."""
    scaled = {}
    for feat, mean, std in fitted.collect():  # one row per feature
        filled = F.coalesce(F.col(feat).cast("double"), F.lit(0.0))
        scaled[feat] = (filled - F.lit(mean)) / F.lit(std or 1.0)
    return df.withColumns(scaled)


def minmax_scale(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """To [0, 1]; a constant column becomes 0."""
    scaled = {}
    for feat, low, high in fitted.collect():  # one row per feature
        if low is None:
            raise ValueError(f"no value of {feat} was fitted")
        width = (high - low) or 1.0
        scaled[feat] = (F.col(feat).cast("double") - F.lit(low)) / F.lit(width)
    return df.withColumns(scaled)


def fit_quantile_bins(df: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Rows `(feat, edges)` for all columns, from one scan; see `quantile_edges`."""
    names = list(bins)
    pairs = [F.struct(F.lit(c).alias("feat"), F.col(c).cast("double").alias("x")) for c in names]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("x").isNotNull())
        .groupBy("feat", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return quantile_edges(counts, bins)


def quantile_edges(counts: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Rows `(feat, edges)`: exact quantiles by linear interpolation, equal edges merged.

    `counts` has one row `(feat, x, n)` per distinct value. The counts are summed up
    along the global order and only the values at the wanted places are kept, so no
    task ever holds a whole column.
    """
    df = counts
    placed = cumulative(counts, ["feat", "x"], {"before": F.col("n")})
    totals = placed.groupBy("feat").agg(F.sum("n").alias("rows"), F.min("before").alias("start"))
    wanted = {}
    start_of = {}
    for feat, rows, start in totals.collect():  # one row per feature
        start_of[feat] = start
        places = [_share(j, bins[feat]) * (rows - 1) for j in range(bins[feat] + 1)]
        wanted[feat] = [(int(p), p) for p in places]
    hits = {
        feat: sorted({w for p, _ in places for w in (p, p + 1)}) for feat, places in wanted.items()
    }
    if not hits:
        return df.sparkSession.createDataFrame([], "feat string, edges array<double>")
    lookup = df.sparkSession.createDataFrame(
        [(f, start_of[f], places) for f, places in hits.items()],
        "feat string, start long, places array<long>",
    )
    first = F.col("before") - F.col("start")
    found = placed.join(F.broadcast(lookup), "feat").select(
        "feat",
        "x",
        F.explode(F.filter("places", lambda p: (p >= first) & (p < first + F.col("n")))).alias("p"),
    )
    value = {(r.feat, r.p): r.x for r in found.collect()}  # two rows per edge
    fitted = []
    for feat, places in wanted.items():
        edges = []
        for place, exact in places:
            low = value[feat, place]
            high = value.get((feat, place + 1), low)
            edges.append(low + (high - low) * (exact - place))
        fitted.append((feat, sorted(set(edges))))
    return df.sparkSession.createDataFrame(fitted, "feat string, edges array<double>")


def _share(j: int, bins: int) -> float:
    """The j-th of `bins + 1` evenly spaced shares, as repeated steps of 1 / bins."""
    return 1.0 if j == bins else j * (1.0 / bins)


def bin_of(column: Column, edges: Sequence[float]) -> Column:
    """Bin number for bins `(low, high]`, the first one closed; outside or NULL gives NULL."""
    x = column.cast("double")
    below = F.lit(0)
    for edge in edges:
        below = below + (x > F.lit(edge)).cast("int")
    inside = (x >= F.lit(edges[0])) & (x <= F.lit(edges[-1]))
    return F.when(inside, F.greatest(below - 1, F.lit(0)))


def quantile_bin(df: DataFrame, fitted: DataFrame, into: dict[str, str] | None = None) -> DataFrame:
    """Replace each column by its bin, or write it to `into[column]`."""
    into = into or {}
    return df.withColumns(
        {into.get(feat, feat): bin_of(F.col(feat), edges) for feat, edges in fitted.collect()}
    )
