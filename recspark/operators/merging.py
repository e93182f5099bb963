"""Fitted state of a new day joined to that of earlier days, without reading old rows.

Counts, sums, moments, ranges, folds and distinct-count sketches of two fits add up to the fit of
both inputs. Dictionaries and vocabularies grow at the end: old codes never change, so models
and indexes built on them stay valid, and only the values that are new are ordered and coded. Both
sides are fitted tables, so a merge moves one row per key and side. Merges are written like fits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .counting import DISTINCT_PREFIX
from .ordering import global_rank

_KEY = ["feature", "number", "key"]


def _summed(a: DataFrame, b: DataFrame, on: Sequence[str], label: str) -> DataFrame:
    """NULL keys are equal in a grouping, which an equi-join would lose."""
    names = [c for c in a.columns if c not in on]
    both = a.unionByName(b).groupBy(*on).agg(*[F.sum(c).alias(c) for c in names])
    return materialize(both.select(*a.columns), label, partition_by=["feature"])


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two results of `fit_counts`."""
    return _summed(a, b, _KEY, "counts")


def merge_target(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two results of `fit_target`; the row of all rows is merged like a key."""
    return _summed(a, b, _KEY, "target")


def merge_minmax(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two results of `fit_minmax`."""
    both = a.unionByName(b).groupBy("feat").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return materialize(both, "minmax")


def fit_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows `(feat, n, mean, squares)`: rows, mean and sum of squared differences from it; NULL
    counts as 0. Unlike a deviation, these can be merged."""
    filled = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns}
    row = df.agg(F.count(F.lit(1)).alias("n"), *[f(v).alias(f"{p}_{c}") for c, v in filled.items() for p, f in (("a", F.avg), ("v", F.var_pop))])
    entries = [
        F.struct(F.lit(c).alias("feat"), "n", F.coalesce(f"a_{c}", F.lit(0.0)).alias("mean"), F.coalesce(F.col(f"v_{c}") * F.col("n"), F.lit(0.0)).alias("squares"))
        for c in columns
    ]
    return materialize(row.select(F.inline(F.array(*entries))), "moments")


def merge_moments(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two results of `fit_moments`: the squares grow by what lies between the means."""
    rows = a.unionByName(b)
    both = rows.groupBy("feat").agg(
        F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"), F.collect_list(F.struct("n", "mean", "squares")).alias("s")
    )
    # two entries per feature
    apart = F.aggregate(
        F.transform("s", lambda x: x["squares"] + x["n"] * F.pow(x["mean"] - F.coalesce("mean", F.lit(0.0)), 2)), F.lit(0.0), lambda t, x: t + x
    )
    return materialize(both.select("feat", "n", F.coalesce("mean", F.lit(0.0)).alias("mean"), apart.alias("squares")), "moments")


def standard_of(moments: DataFrame) -> DataFrame:
    """`(feat, mean, std)` as `fit_standard` gives it."""
    return moments.select("feat", "mean", F.sqrt(F.coalesce(F.try_divide("squares", "n"), F.lit(0.0))).alias("std"))


def merge_dictionary(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two results of `fit_dictionary`: the codes of `old`, then the other values of `new` in their
    own order; `n` is added up."""
    seen = old.select("feature", "value", *[F.col(c).alias(n) for c, n in (("code", "_old"), ("n", "_n"), ("number", "_number"))])
    met = materialize(new.join(seen, ["feature", "value"], "full"), "dictionary-parts")
    total = (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n")
    number = F.coalesce("number", "_number").alias("number")
    kept = met.where("_old IS NOT NULL").select("feature", number, "value", F.col("_old").alias("code"), total)
    # one row per feature
    ends = F.broadcast(old.groupBy("feature").agg(F.max("code").alias("_last")))
    ranked = global_rank(met.where("_old IS NULL").select("feature", "number", "value", "code", "n"), ["feature", "code"], "_rank")
    firsts = F.broadcast(ranked.groupBy("feature").agg(F.min("_rank").alias("_first"), F.min("code").alias("_least")))
    added = ranked.join(firsts, "feature").join(ends, "feature", "left")
    begin = F.coalesce(F.col("_last") + 1, F.col("_least"))
    added = added.select("feature", "number", "value", (begin + F.col("_rank") - F.col("_first")).alias("code"), "n")
    return materialize(kept.unionByName(added), "dictionary", partition_by=["feature"])


def merge_vocabulary(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two vocabularies `(token, id, n)`: old ids stay, new tokens follow in the order of their ids."""
    met = old.select("token", "id", "n").join(new.select("token", F.col("id").alias("_id"), F.col("n").alias("_n")), "token", "full")
    met = materialize(met, "vocabulary-parts")
    total = (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n")
    kept = met.where("id IS NOT NULL").select("token", "id", total)
    last = old.agg(F.max("id")).first()[0]
    added = met.where("id IS NULL").select("token", F.col("_id").alias("place"), F.col("_n").alias("n"))
    added = global_rank(added, ["place"], "id", start=0 if last is None else last + 1).select("token", "id", "n")
    return materialize(kept.unionByName(added), "vocabulary")


def merge_sketches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two results of `counting.fit_distinct_sketches`."""
    names = [c for c in a.columns if c.startswith(DISTINCT_PREFIX)]
    united = [F.hll_union_agg(c).alias(c) for c in names]
    both = a.unionByName(b).groupBy(*_KEY).agg(F.sum("n").alias("n"), *united)
    return materialize(both.select(*a.columns), "sketches", partition_by=["feature"])
