"""Word and item embeddings: training, lookup, similarity, analogy."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import cosine, l2_normalize, zeros
from ..storage import materialize
from . import skipgram
from .ordering import global_rank
from .skew import ROWS_PER_TASK, attach, attach_side

TOKENS_PER_PART = 1 << 20  # of one part in training, which bounds its words
ROWS_PER_BUCKET = 1 << 16  # vectors averaged at a time
_PART = "part long, id long, token string, touched boolean, vector array<float>"


def train_vectors(
    df: DataFrame,
    tokens: str,
    size: int = 100,
    window: int = 3,
    min_count: int = 1,
    partitions: int | None = None,
    seed: int = 42,
    iterations: int = 1,
) -> DataFrame:
    """`(token, vector)` by skip-gram with hierarchical softmax.

    The reference library's default is the bag-of-words form with negative sampling,
    so single similarities differ. It trains in as many parts as the session runs tasks, or
    more of TOKENS_PER_PART tokens, or in `partitions`; each part sees its own rows and the parts
    are averaged. A part holds the vectors of its own words and of the inner nodes above them; the
    driver gets the number of words per count, never a word or a vector.
    """
    lists = df.select(F.col(tokens).cast("array<string>").alias("tokens")).where("tokens IS NOT NULL")
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not partitions:
        total = lists.agg(F.sum(F.size("tokens"))).first()[0] or 0
        partitions = max(cores, -(-total // TOKENS_PER_PART))
    labels = F.array(*[F.lit(i) for i in _labels(df.sparkSession, partitions)])
    part = F.get(labels, F.pmod(F.spark_partition_id(), F.size(labels))).cast("long").alias("part")
    sentences = materialize(lists.repartition(partitions).select(part, "tokens"), "sentences")
    own = sentences.select("part", F.explode("tokens").alias("token"))
    own = materialize(own.groupBy("part", "token").agg(F.count(F.lit(1)).alias("n")), "part-words")
    words = own.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    ranked = global_rank(words, [F.desc("n"), "token"], "id")
    # at most the root of twice the tokens
    lengths = skipgram.code_lengths(ranked.groupBy("n").count().collect())
    if not lengths:
        raise ValueError(f"no word occurs {min_count} times")
    same = F.col("o.token").eqNullSafe(F.col("r.token"))
    known = own.alias("o").join(ranked.alias("r"), same).select("part", "o.token", "id")
    known = known.withColumn("vector", F.lit(None).cast("array<float>"))
    buckets = max(cores, -(-own.count() // ROWS_PER_BUCKET))

    def trained(start: int, stop: int) -> DataFrame:
        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            return skipgram.train_part(a, b, lengths, size, window, seed, (start, stop, iterations))

        sides = [x.repartition(partitions, "part").groupBy("part") for x in (sentences, known)]
        return sides[0].cogroup(sides[1]).applyInArrow(run, _PART)

    def averaged(rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket")
        mean = rows.select(bucket, "id", "token", "touched", "vector").groupBy("bucket")
        return materialize(mean.applyInArrow(lambda x: skipgram.mean_rows(x, size), "id long, token string, vector array<float>"), "vectors")

    done = 0
    while partitions > 1 and done < iterations - 1:
        rows = materialize(trained(done, done + 1), "trained")
        known = rows.select("part", "id", "token").join(averaged(rows).drop("token"), "id")
        done += 1
    return averaged(trained(done, iterations)).select("token", F.col("vector").cast("array<double>").alias("vector"))


def _labels(spark: SparkSession, parts: int) -> list[int]:
    """As many numbers that a shuffle into `parts` deals to different tasks."""
    place = F.pmod(F.hash("id"), F.lit(parts))
    rows = spark.range(64 * parts).groupBy(place.alias("place")).agg(F.min("id").alias("id"))
    return [r.id for r in rows.orderBy("place").collect()]


def pair_similarity(pairs: DataFrame, vectors: DataFrame, first: str, second: str) -> DataFrame:
    """Cosine of the two words of each row; NULL when a word has no vector."""
    a = vectors.select(F.col("token").alias(first), F.col("vector").alias("_a"))
    b = vectors.select(F.col("token").alias(second), F.col("vector").alias("_b"))
    joined = attach_side(attach_side(pairs, a, [first]), b, [second])
    return joined.select(*pairs.columns, cosine(F.col("_a"), F.col("_b")).alias("similarity"))


def analogy(
    vectors: DataFrame, positive: Sequence[str], negative: Sequence[str] = (), k: int = 10
) -> DataFrame:
    """The k words nearest to the mean of the signed unit vectors; the inputs are left out."""
    sign = F.when(F.col("token").isin(list(positive)), 1.0).otherwise(-1.0)
    given = [*positive, *negative]
    chosen = vectors.where(F.col("token").isin(given))
    unit = array_to_vector(l2_normalize(F.transform("vector", lambda x: x * sign)))
    # one vector for a fixed list of words
    if chosen.isEmpty():
        raise ValueError(f"none of these words has a vector: {given}")
    mean = chosen.agg(vector_to_array(Summarizer.mean(unit)).alias("mean")).first()["mean"]
    query = F.array(*[F.lit(float(x)) for x in mean])
    others = vectors.where(~F.col("token").isin(given))
    scored = others.select("token", cosine(F.col("vector"), query).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), "token").limit(k)


def index_rows(
    df: DataFrame, key: Sequence[str], tokens: Column, vocabulary: DataFrame, length: int
) -> DataFrame:
    """`(key.., ids)`: vocabulary indexes, unknown 0, the first `length`, filled with 0."""
    from ..functions.arrays import pad
    from .sequences import sequence_ids

    coded = sequence_ids(df, key, F.slice(tokens, 1, length), vocabulary, 0)
    return coded.withColumn("ids", pad(F.col("ids"), length, keep="first"))


def index_words(
    df: DataFrame,
    key: Sequence[str],
    ids: str,
    vocabulary: DataFrame,
    padding: str = "<PAD>",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`(key.., tokens)`: indexes back to words; an index without a word gives the padding word."""
    exploded = df.select(*key, F.posexplode(ids).alias("_pos", "id"))
    joined = attach(exploded, vocabulary, ["id"], rows_per_task=rows_per_task)
    entry = F.struct("_pos", F.coalesce("token", F.lit(padding)).alias("token"))
    entries = F.array_sort(F.collect_list(entry))
    return joined.groupBy(*key).agg(F.transform(entries, lambda e: e["token"]).alias("tokens"))


def vector_rows(
    df: DataFrame,
    key: Sequence[str],
    tokens: Column,
    vectors: DataFrame,
    size: int,
    on: str = "token",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`(key.., pos, vector)`: one row per token; unknown tokens get the zero vector.

    `vectors` is `(token, vector, n)`, with `n` the occurrences of the token.
    """
    exploded = df.select(*key, F.posexplode(tokens).alias("pos", on))
    joined = attach(exploded, vectors, [on], rows_per_task=rows_per_task)
    return joined.select(*key, "pos", on, F.coalesce("vector", zeros(size)).alias("vector"))
