"""Scans: files to DataFrames, always with a given schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import characters


def delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = "\t",
    header: bool = False,
    quoted_empty_is_null: bool = True,
) -> DataFrame:
    """Delimited text. Short rows get trailing NULLs, a quoted empty text becomes NULL."""
    df = spark.read.csv(path, schema=schema, sep=sep, header=header, mode="PERMISSIVE")
    if not quoted_empty_is_null:
        return df
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in texts})


def json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def keyed_json(
    spark: SparkSession, path: str, key: str, names: Sequence[str] | None, item: str = "double"
) -> DataFrame:
    """One JSON object per file, `{key: [v0, v1, ..]}`: a row per key.

    With `names` the list becomes named columns, else one array column `items`.
    """
    whole = spark.read.text(path, wholetext=True)
    entries = whole.select(
        F.explode(F.from_json("value", f"map<string, array<{item}>>")).alias(key, "items")
    )
    if names is None:
        return entries
    return entries.select(key, *[F.get("items", i).alias(c) for i, c in enumerate(names)])


def text_files(
    spark: SparkSession, folder: str, extension: str | None = None, whole: bool = False
) -> DataFrame:
    """All text files below `folder`, any depth: `path` and `value` (a line, or the whole file)."""
    reader = spark.read.option("recursiveFileLookup", True)
    if extension:
        reader = reader.option("pathGlobFilter", f"*.{extension.split('.')[-1]}")
    return reader.text(folder, wholetext=whole).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def folder_label(path: Column) -> Column:
    """The second-last part of a path: the folder a labelled file lies in."""
    return F.element_at(F.split(path, "/"), -2)


def positive_negative(
    spark: SparkSession, positive: str, negative: str, kept: str | None = None
) -> DataFrame:
    """Two text files, one sentence per line, to tokens and a two-column label."""

    def side(path: str, label: list[int]) -> DataFrame:
        text = F.col("value")
        tokens = F.split(text, " ") if kept is None else characters(text, kept)
        return spark.read.text(path).select(
            tokens.alias("tokens"), F.array(*[F.lit(x) for x in label]).alias("label")
        )

    return side(positive, [0, 1]).unionByName(side(negative, [1, 0]))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """One entry per line, stripped."""
    return spark.read.text(path).select(
        F.regexp_replace("value", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "").alias("word")
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows of each file of a scan, and one row with the total (`file` is NULL)."""
    named = df.select(F.col("_metadata.file_name").alias("file"))
    return named.rollup("file").agg(F.count(F.lit(1)).alias("rows"))
