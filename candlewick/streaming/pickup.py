"""Incremental load: each bronze file is picked up once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.plans.gold import Gold, check_layers, refresh_gold
from candlewick.plans.load import Load, bronze_to_silver
from candlewick.sources.bronze import FILE_SCHEMA, landed_lines, landings


def pick_up(
    spark: SparkSession,
    path: str,
    schema: str,
    checkpoint: str,
    run_time: str,
    whole_files: bool = False,
    files_per_batch: int | None = None,
    on_batch: Callable[[Load], None] | None = None,
    raise_on_reject: bool = False,
    packed: bool = False,
) -> None:
    """Load all files not seen under ``checkpoint`` yet, then stop; ``packed`` files are those of ``write_packed``.

    A batch that is delivered again is harmless, because the load ignores stored keys.  ``on_batch`` gets the whole load;
    its scratch tables are deleted after that.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, _: int) -> None:
        result = bronze_to_silver(batch, schema, run_time, raise_on_reject)
        if on_batch is not None:
            on_batch(result)
        result.release()

    query = (
        landed_lines(reader, path, whole_files, packed)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()


def refresh(
    spark: SparkSession, path: str, schema: str, seed: DataFrame, checkpoint: str, run_time: str, check: bool = False
) -> Gold:
    """Pick up new files and bring gold up to date with what they touched; ``check`` raises where a contract is broken."""
    pick_up(spark, path, schema, checkpoint, run_time)
    gold = refresh_gold(spark, schema, seed)
    if check:
        check_layers(spark, schema, raise_errors=True)
    return gold


def track_newest(spark: SparkSession, path: str, checkpoint: str, out: str) -> None:
    """Bring the newest landing of each symbol under ``out`` up to date with the files not seen yet, then stop.

    The state is one (date, run) per symbol.  A batch writes the symbols that it changed to a folder of its own, so one that is
    delivered again replaces itself; no payload is read.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True).load(path)
    query = (
        landings(files)
        .groupBy("symbol")
        .agg(F.max("at").alias("at"))
        .writeStream.outputMode("update")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()


def tracked_newest(spark: SparkSession, out: str) -> DataFrame:
    """Symbol, date and run of the newest landing that ``track_newest`` has seen; a later batch never names an older one."""
    seen = spark.read.parquet(out)
    return seen.groupBy("symbol").agg(F.max("at").alias("at")).select("symbol", "at.*")
