"""Fitted tables are written, not cached: a lost executor costs no recomputation,
and the written size lets Catalyst decide by itself whether a join may broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only for `local[..]`."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="recspark-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/recspark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` to the shared folder and return the written table.

    A partitioned table is rebalanced first, which gives each folder few files and
    splits a folder that holds most of the rows over several tasks.
    """
    path = new_path(df.sparkSession, label)
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
