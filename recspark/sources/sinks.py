"""Sinks: DataFrames to files, one file or more per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", decimals: int | None = 4, header: bool = True
) -> None:
    """Delimited text; fractions with a fixed number of decimals."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if decimals is not None and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            text = F.format_string(f"%.{decimals}f", column.cast("double"))
            column = F.when(column.isNotNull(), text).alias(field.name)
        columns.append(column)
    df.select(*columns).write.csv(path, sep=sep, header=header)


def write_dictionary(df: DataFrame, path: str, key: str, items: str) -> None:
    """`(key, list)` rows as JSON lines."""
    df.select(key, items).write.json(path)


def write_labelled_ids(
    df: DataFrame, path: str, label: str, ids: str, rows_per_file: int, shuffle_by: Column | None = None
) -> None:
    """Label and id list, at most `rows_per_file` rows in a file, optionally shuffled first."""
    chosen = df.select(F.col(label).alias("label"), F.col(ids).alias("tokens"))
    if shuffle_by is not None:
        chosen = df.orderBy(shuffle_by).select(
            F.col(label).alias("label"), F.col(ids).alias("tokens")
        )
    chosen.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_documents(
    files: DataFrame, path: str, documents_per_file: int, tokens: Column | None = None
) -> None:
    """Many small files (`path`, whole `value`) into fewer, one document per line."""
    body = F.array_join(tokens, " ") if tokens is not None else F.col("value")
    line = F.trim(F.regexp_replace(body, "[\r\n]+", " ")).alias("value")
    # the scan already packs small files into one task, so no shuffle is needed
    files.select(line).write.option("maxRecordsPerFile", documents_per_file).text(path)


def write_fitted(tables: dict[str, DataFrame], path: str) -> None:
    """Keep fitted tables, one folder each."""
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")


def read_fitted(spark, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
