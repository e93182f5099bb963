"""Session settings used by the tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "recspark") -> SparkSession:
    """A `local[cpus]` session; on a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RECSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
