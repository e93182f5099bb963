"""Vocabularies, id sequences and user histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import pad, split_list
from ..storage import materialize
from .ordering import global_rank
from .skew import ROWS_PER_TASK, attach, attach_side, key_profile, running_sums

OOV = "OOV"


def _first_seen(df: DataFrame, tokens: Column, order_by: Sequence[str]) -> DataFrame:
    exploded = df.select(*order_by, F.posexplode(tokens).alias("_pos", "token"))
    place = F.struct(*order_by, "_pos")
    if len(order_by) == 1 and isinstance(df.schema[order_by[0]].dataType, T.IntegralType):
        # one number instead of a pair: the least of it needs no sort of the tokens
        shift = F.lit(1 << 32).cast("decimal(11,0)")
        place = F.col(order_by[0]).cast("decimal(20,0)") * shift + F.col("_pos")
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))


def fit_vocabulary(df: DataFrame, tokens: Column, order_by: Sequence[str]) -> DataFrame:
    """`(token, id, n)`: id 1 is for unknown words, then by count, ties by first appearance."""
    seen = _first_seen(df, tokens, order_by)
    ranked = global_rank(seen, [F.desc("n"), "first"], "id", start=2).select("token", "id", "n")
    oov = df.sparkSession.createDataFrame([(OOV, 1, 0)], ranked.schema)
    return materialize(ranked.unionByName(oov), "vocabulary")


def fit_first_seen_vocabulary(
    df: DataFrame, tokens: Column, order_by: Sequence[str]
) -> DataFrame:
    """`(token, id, n)`: ids from 1 in the order of first appearance; 0 is padding."""
    ranked = global_rank(_first_seen(df, tokens, order_by), ["first"], "id", start=1)
    return materialize(ranked.select("token", "id", "n"), "vocabulary")


def sequence_ids(
    df: DataFrame,
    key: Sequence[str],
    tokens: Column,
    vocabulary: DataFrame,
    unknown: int,
    name: str = "ids",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`(key.., ids)`: the ids of the tokens of each row, in order; `key` is unique.

    `vocabulary` is `(token, id, n)`. A common word is a hot key, so its rows are split.
    """
    exploded = df.select(*key, F.posexplode_outer(tokens).alias("_pos", "_token"))
    known = vocabulary.select(F.col("token").alias("_token"), F.col("id").alias("_id"), "n")
    joined = attach(exploded, known, ["_token"], rows_per_task=rows_per_task)
    entry = F.struct("_pos", F.coalesce("_id", F.lit(unknown).cast("long")).alias("id"))
    entries = F.collect_list(F.when(F.col("_pos").isNotNull(), entry))
    return joined.groupBy(*key).agg(
        F.transform(F.array_sort(entries), lambda e: e["id"]).alias(name)
    )


def without_listed(
    df: DataFrame, key: Sequence[str], tokens: Column, stop: DataFrame, word: str = "word"
) -> DataFrame:
    """`(key.., tokens)` without the words of a long list; order and repeats stay."""
    exploded = df.select(*key, F.posexplode_outer(tokens).alias("_pos", word))
    listed = stop.select(word).distinct().withColumn("_listed", F.lit(True))
    marked = attach_side(exploded, listed, [word])
    kept = F.when(F.col("_pos").isNotNull() & F.col("_listed").isNull(), F.struct("_pos", word))
    entries = F.array_sort(F.collect_list(kept))
    return marked.groupBy(*key).agg(F.transform(entries, lambda e: e[word]).alias("tokens"))


def longest(df: DataFrame, name: str) -> int:
    return df.agg(F.max(F.size(name))).first()[0] or 0


def pad_to_longest(df: DataFrame, name: str) -> DataFrame:
    """Zeros at the end, up to the longest list of the table."""
    df = materialize(df, "lists")  # read twice
    return df.withColumn(name, pad(F.col(name), longest(df, name)))


def history_codes(
    df: DataFrame,
    key: Sequence[str],
    history: str,
    dictionary: DataFrame,
    length: int = 5,
    separators: str = ",",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Delimited history to codes of the main column's dictionary `(value, code, n)`.

    Unknown values become 0; lists are cut to their last `length` entries or filled with 0.
    """
    vocabulary = dictionary.select(F.col("value").alias("token"), F.col("code").alias("id"), "n")
    tokens = split_list(F.col(history), separators)
    coded = sequence_ids(df, key, tokens, vocabulary, 0, history, rows_per_task)
    return coded.withColumn(history, pad(F.col(history), length))


def user_items(
    df: DataFrame,
    user: str,
    item: str,
    order_by: Sequence[str],
    chunk: int = 10_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All items of each user in order, as rows `(user, chunk, items)`.

    A list holds at most `chunk` items and longer histories go on in the next chunk,
    so that a user with a third of all rows does not become one cell in one task.
    """
    profile = materialize(key_profile(df, [user]), "profile")
    placed = running_sums(df, profile, [user], order_by, {"_place": F.lit(1)}, rows_per_task)
    chunked = placed.withColumn("chunk", F.floor(F.col("_place") / chunk).cast("int"))
    entries = F.array_sort(F.collect_list(F.struct("_place", F.col(item).alias("item"))))
    return chunked.groupBy(user, "chunk").agg(F.transform(entries, lambda e: e["item"]).alias("items"))


def last_items(
    df: DataFrame, user: str, item: str, order_by: Sequence[str], length: int = 5
) -> DataFrame:
    """`(user, items)`: the last `length` items of each user, oldest first.

    This is the full list after truncation; Spark keeps `length` rows per user before
    the shuffle.
    """
    newest = Window.partitionBy(user).orderBy(*[F.desc(c) for c in order_by])
    kept = df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= length)
    entries = F.sort_array(F.collect_list(F.struct("_n", F.col(item).alias("item"))), asc=False)
    return kept.groupBy(user).agg(F.transform(entries, lambda e: e["item"]).alias("items"))
