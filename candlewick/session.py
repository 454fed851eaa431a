"""Session defaults for standalone use; a session made elsewhere works as well."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", app: str = "candlewick", **extra: str) -> SparkSession:
    """Session for one machine; on a cluster the submitting side sets master and resources."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    partitions = "8" if cores == "*" else str(cores)
    builder = builder.config("spark.sql.shuffle.partitions", partitions)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
