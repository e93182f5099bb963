"""Corpus pipeline: quality, repeated lines, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and reread as the
next stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import decontamination, jaccard, line_runs, packing, quality
from recspark.session import table
from recspark.storage import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score of quality is at least 0.3 stay."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model, "_score").where(F.col("_score") >= 0.3).drop("_score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing is left;
    `n_chars` is that of the text left."""
    left = line_runs.without_repeats(docs)
    left = left.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = F.when(F.col("n_removed") > 0, size).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 token ids and the sequences that hold them."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packed),
]

# a trained classifier decides in the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
