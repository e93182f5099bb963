"""Distributed evaluation. Every metric is one row; a metric without a meaning is NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import cumulative

CLIP = 1e-15  # fixed value: probabilities are kept this far from 0 and 1


def roc_aucs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """`(pair, auc)`, by the number of each (label, score) pair: exact areas under the curve with
    ties, NULL when only one class occurs.

    All pairs share one scan, one count per distinct score and one global order. Labels of one
    score are columns of it; several scores follow each other in the order, and what stands
    before a score's first row is taken off at the end.
    """
    scores = list(dict.fromkeys(score for _, score in pairs))
    labels = [[label for label, own in pairs if own == score] for score in scores]
    width = max(map(len, labels))
    entries = [
        F.struct(
            F.lit(k).alias("k"),
            F.col(score).cast("double").alias("s"),
            *[(F.col(own[i]) if i < len(own) else F.lit(None)).cast("int").alias(f"y{i}") for i in range(width)],
        )
        for k, (score, own) in enumerate(zip(scores, labels))
    ]
    columns = range(width)
    counts = df.select(F.inline(F.array(*entries))).groupBy("k", "s")
    counted = [F.count_if(F.col(f"y{i}") == y).alias(f"{n}{i}") for i in columns for n, y in (("pos", 1), ("neg", 0))]
    placed = cumulative(counts.agg(*counted), ["k", "s"], {f"below{i}": F.col(f"neg{i}") for i in columns})
    won = [F.sum(F.col(f"pos{i}") * (F.col(f"below{i}") + F.col(f"neg{i}") / 2)).alias(f"won{i}") for i in columns]
    sums = placed.groupBy("k").agg(*won, *[F.sum(f"{n}{i}").alias(f"{n}{i}") for i in columns for n in ("pos", "neg")])
    # one row per score
    earlier = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    areas = []
    for i in columns:
        before = F.coalesce(F.sum(f"neg{i}").over(earlier), F.lit(0))
        pos = F.col(f"pos{i}").cast("double")
        area = F.try_divide(F.col(f"won{i}") - pos * before, F.nullif(pos * F.col(f"neg{i}"), F.lit(0.0)))
        areas.append(area.alias(f"auc{i}"))
    found = sums.select("k", *areas)
    numbers = {(k, i): pairs.index((label, score)) for k, (score, own) in enumerate(zip(scores, labels)) for i, label in enumerate(own)}
    rows = df.sparkSession.createDataFrame([(n, k, i) for (k, i), n in numbers.items()], "pair int, k int, i int")
    listed = found.select("k", F.posexplode(F.array(*[f"auc{i}" for i in columns])).alias("i", "auc"))
    return rows.join(listed, ["k", "i"], "left").select("pair", "auc")


def roc_auc(df: DataFrame, label: str, score: str, name: str = "auc") -> DataFrame:
    """Exact area under the curve with ties; NULL when only one class occurs."""
    return roc_aucs(df, [(label, score)]).select(F.col("auc").alias(name))


def log_loss_of(label: Column, score: Column) -> Column:
    p = F.greatest(F.least(score, F.lit(1 - CLIP)), F.lit(CLIP))
    return -(label * F.log(p) + (1 - label) * F.log(1 - p))


def log_loss(df: DataFrame, label: str, score: str, name: str = "log_loss") -> DataFrame:
    return df.agg(F.avg(log_loss_of(F.col(label), F.col(score))).alias(name))


def accuracy(df: DataFrame, label: str, score: str, name: str = "accuracy") -> DataFrame:
    right = ((F.col(score) > 0.5).cast("int") == F.col(label)).cast("int")
    return df.agg(F.avg(right).alias(name))


def mse(df: DataFrame, target: str, prediction: str, name: str = "mse") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(target) - F.col(prediction), 2)).alias(name))


def weighted_auc(
    df: DataFrame, first: tuple[str, str], second: tuple[str, str], weights=(0.7, 0.3)
) -> DataFrame:
    """Weighted sum of two AUCs, given as `(label, score)` pairs."""
    weight = F.when(F.col("pair") == 0, weights[0]).otherwise(weights[1])
    if first == second:
        return roc_auc(df, *first, "score").select((F.col("score") * sum(weights)).alias("score"))
    found = roc_aucs(df, [first, second])
    # without one of the areas there is no score
    return found.agg(F.when(F.count("auc") == 2, F.sum(F.col("auc") * weight)).alias("score"))


def recall_at(
    ranked: DataFrame, truth: DataFrame, user: str, item: str, place: str, cutoffs: tuple[int, ...]
) -> DataFrame:
    """Mean over the users in `truth` of |top-N and truth| / |truth|, for each cutoff.

    `ranked` has one row per recommendation with its 1-based place, `truth` one per
    held-out item. Both are rows, so a user with many of them is no large cell.
    """
    known = truth.select(user, item).distinct()
    best = ranked.groupBy(user, item).agg(F.min(place).alias("_place"))
    matched = known.join(best, [user, item], "left")
    per_user = matched.groupBy(user).agg(
        *[F.avg(F.coalesce((F.col("_place") <= n).cast("int"), F.lit(0))).alias(f"r{n}") for n in cutoffs]
    )
    return per_user.agg(*[F.avg(f"r{n}").alias(f"recall_at_{n}") for n in cutoffs])
