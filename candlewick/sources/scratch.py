"""Intermediate results written once to the cluster's shared folder.

A written table survives lost executors, cuts the lineage, and gives the optimizer the true size of
what follows.  That size is what decides between a broadcast and a shuffled join: no join in this
package carries a broadcast hint, so a lookup that outgrows ``autoBroadcastJoinThreshold`` goes to a
sort-merge join, where adaptive execution splits hot keys.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="candlewick-")


def _root(spark: SparkSession) -> str:
    """The shared folder the cluster names; on one machine without one, a folder of this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh folder under ``spark.checkpoint.dir``, grouped by application for later clean-up."""
    return f"{_root(spark)}/candlewick/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_freed(spark: SparkSession, free: bool) -> Iterator[None]:
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true" if free else before)
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def materialise(df: DataFrame, label: str, used: list[str] | None = None, free: bool = False) -> DataFrame:
    """Write ``df`` once and return the written table; its folder is added to ``used``.

    With ``free`` the shuffle files of the write are deleted as soon as it ends; otherwise they stay until the driver's
    memory is next cleaned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _shuffles_freed(spark, free):
        df.write.parquet(path)
    if used is not None:
        used.append(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, label: str, key: str, used: list[str]) -> DataFrame:
    """As ``materialise`` with ``free``, in buckets of ``key``: joins on it shuffle the other side only.

    The catalog knows the table until it is read back; no name stays there.
    """
    spark = df.sparkSession
    path, buckets = scratch_path(spark, label), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"scratch_{uuid.uuid4().hex}"
    try:
        with _shuffles_freed(spark, True):
            df.repartition(buckets, key).write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(name)
        written = spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    used.append(path)
    return written.select(*df.columns)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders whose results are stored elsewhere."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    paths.clear()
