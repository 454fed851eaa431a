"""Catalog tables: set-up, model rebuilds and the audit sink."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas as S

from .scratch import discard, materialise

log = logging.getLogger(__name__)

SILVER = "weekly_adjusted_prices"
AUDIT = "pipeline_audit"
QUARANTINE = "payload_quarantine"
CHANGES = "silver_changes"
REFRESHES = "gold_refreshes"
#: Between the name of a model and that of one of its builds.
VERSION = "__v"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)


def setup_tables(spark: SparkSession, schema: str, location: str | None = None, buckets: int | None = None) -> None:
    """Create the schema and the silver, audit and quarantine tables where missing.

    Silver is stored by year, so a load compares its keys with the years it touches and no others.  With ``buckets`` each year is
    cut by the hash of the keys as well: a load too large for a broadcast is then shuffled to the stored keys, which stay where
    they are.  That needs at least as many buckets as ``spark.sql.shuffle.partitions``, and costs a file per year and bucket.
    """
    clustered = f" CLUSTERED BY ({', '.join(S.SILVER_KEY)}) INTO {buckets} BUCKETS" if buckets else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {schema}.{SILVER} ({_columns(S.SILVER_SCHEMA)}, {S.SILVER_PART} int) USING parquet "
        f"PARTITIONED BY ({S.SILVER_PART}){clustered}"
    )
    for name, columns in ((AUDIT, S.AUDIT_SCHEMA), (CHANGES, S.CHANGES_SCHEMA), (REFRESHES, S.REFRESHES_SCHEMA)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({_columns(columns)}) USING parquet")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {schema}.{QUARANTINE} ({_columns(S.QUARANTINE_SCHEMA)}, {S.QUARANTINE_DIGEST} string, "
        f"{S.QUARANTINE_DAY} date) USING parquet PARTITIONED BY ({S.QUARANTINE_DAY})"
    )


def fresh_table(spark: SparkSession, table: str) -> DataFrame:
    """A table with the files it has now: a session keeps the listing it made, and streams write from sessions of their own."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def read_table(spark: SparkSession, schema: str, name: str) -> DataFrame:
    df = fresh_table(spark, f"{schema}.{name}")
    return df.drop(S.SILVER_PART) if name == SILVER else df


def stored_years(batch: DataFrame, schema: str, years: Sequence[int] | None = None) -> DataFrame:
    """Silver of the years that a batch touches, looked up unless given; the number of years is the calendar's."""
    if years is None:
        years = [r[0] for r in batch.select(F.year("price_date")).distinct().collect()]
    stored = fresh_table(batch.sparkSession, f"{schema}.{SILVER}")
    return stored.filter(F.col(S.SILVER_PART).isin(years)).drop(S.SILVER_PART)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` has rows for, in one commit; all others stay.

    ``insertInto`` takes the mode from the session and ignores a writer's option.
    """
    conf = df.sparkSession.conf
    before = conf.get(_OVERWRITE_MODE)
    conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        conf.set(_OVERWRITE_MODE, before)


def append_rows(df: DataFrame, table: str) -> None:
    df.write.insertInto(table)


def current_version(spark: SparkSession, schema: str, name: str) -> str | None:
    """Table that the view of a model reads, if it is published."""
    if not spark.catalog.tableExists(f"{schema}.{name}"):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.{name}").filter("col_name = 'View Text'").first()
    return None if text is None else text["data_type"].split(" FROM ")[-1]


def build_version(df: DataFrame, schema: str, name: str, parts: Sequence[str] = ()) -> str:
    """Store a fresh build of a model beside the published one; returns its table."""
    table = f"{schema}.{name}{VERSION}{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").partitionBy(*parts).saveAsTable(table)
    return table


def publish(spark: SparkSession, schema: str, versions: Mapping[str, str]) -> None:
    """Let each model's view read its new build: one catalog operation a model.

    Until then readers see the build before, also when a build fails.  That one is kept for plans that still read it; older
    ones, and what failed builds left, are dropped.
    """
    for name, table in versions.items():
        before = current_version(spark, schema, name)
        if before is None:
            spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS SELECT * FROM {table}")
        stored = [f"{schema}.{t.name}" for t in spark.catalog.listTables(schema, f"{name}{VERSION}*")]
        for old in stored:
            if old not in (table, before):
                spark.sql(f"DROP TABLE IF EXISTS {old}")


def write_model(df: DataFrame, schema: str, name: str, parts: Sequence[str] = ()) -> DataFrame:
    """Rebuild one model and publish it (for `dim_stock` that is SCD type 1)."""
    publish(df.sparkSession, schema, {name: build_version(df, schema, name, parts)})
    return df.sparkSession.table(f"{schema}.{name}")


def append_changes(rows: DataFrame, schema: str) -> None:
    """Note the years and symbols that a load is about to touch.

    Comes before the rows themselves: a load that dies in between leaves a note too many, which only makes gold rebuild a part
    that has not changed.
    """
    keys = rows.select(F.year("price_date").alias("price_year"), "symbol").distinct()
    keys.select(F.lit(uuid.uuid4().hex).alias("load_id"), "price_year", "symbol").write.insertInto(f"{schema}.{CHANGES}")


def pending_changes(spark: SparkSession, schema: str) -> DataFrame:
    """Changes of the loads that gold has not taken over yet."""
    done = fresh_table(spark, f"{schema}.{REFRESHES}")
    return fresh_table(spark, f"{schema}.{CHANGES}").join(done, "load_id", "left_anti")


def mark_refreshed(changes: DataFrame, schema: str) -> None:
    changes.select("load_id").distinct().write.insertInto(f"{schema}.{REFRESHES}")


def _complete(rows: DataFrame) -> DataFrame:
    """Column defaults of the silver table; a missing key or an over-long text stops the write."""
    silver = {f.name: f for f in S.SILVER_SCHEMA}

    def refuse(name: str, what: str):
        return F.raise_error(F.lit(f"{name} {what}")).cast(silver[name].dataType)

    def short(name: str, c, most: int):
        return F.when(F.length(c) > most, refuse(name, f"is longer than {most}")).otherwise(c)

    source = F.coalesce("_data_source", F.lit(S.DATA_SOURCE))
    symbol = short("symbol", F.col("symbol"), S.MAX_SYMBOL_LENGTH)
    return rows.withColumns(
        {
            "price_date": F.coalesce("price_date", refuse("price_date", "is null")),
            "symbol": F.coalesce(symbol, refuse("symbol", "is null")),
            "_data_source": short("_data_source", source, S.MAX_SOURCE_LENGTH),
            "_processing_date": F.coalesce("_processing_date", F.current_date()),
        }
    ).select(*silver, F.year("price_date").alias(S.SILVER_PART))


def append_silver(rows: DataFrame, schema: str) -> None:
    """Append rows as new files; they become visible when the job commits.

    A year gets one file from a small load, and several of the advised size from a large one.
    """
    _complete(rows).hint("rebalance", S.SILVER_PART).sortWithinPartitions(S.SILVER_PART, "price_date", "symbol").write.insertInto(
        f"{schema}.{SILVER}"
    )


def compact_silver(spark: SparkSession, schema: str, max_files: int = 16) -> list[int]:
    """Write the years that have more than ``max_files`` files, in any bucket if there are some, anew; returns them.

    Their rows are copied to scratch first, so a failure in between leaves the table as it was.
    """
    table = fresh_table(spark, f"{schema}.{SILVER}")
    # A file of a bucket ends in the number of the bucket; the others have none.
    path = F.col("_metadata.file_path")
    files = table.select(S.SILVER_PART, path.alias("file"), F.regexp_extract(path, r"_(\d+)\.c\d+\.[^/]*$", 1).alias("bucket")).distinct()
    counts = files.groupBy(S.SILVER_PART, "bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_files)
    years = sorted(r[S.SILVER_PART] for r in counts.select(S.SILVER_PART).distinct().collect())
    if years:
        used: list[str] = []
        rows = materialise(table.filter(F.col(S.SILVER_PART).isin(years)), "compact-years", used)
        sorted_rows = rows.hint("rebalance", S.SILVER_PART).sortWithinPartitions(S.SILVER_PART, "price_date", "symbol")
        overwrite_partitions(sorted_rows, f"{schema}.{SILVER}")
        discard(spark, used)
    return years


def append_quarantine(rejected: DataFrame, schema: str, days: Sequence | None = None) -> None:
    """Keep rejected payloads with reason and origin; one that is there already is not stored again.

    The digest of a payload is stored with it, by the day of its landing, so only the digests of the days that the batch has
    payloads of are read; the number of those days is the calendar's.
    """
    columns, key = S.QUARANTINE_SCHEMA.names, [S.QUARANTINE_DAY, S.QUARANTINE_DIGEST]
    digest = F.sha2(F.to_json(F.struct(*columns)).cast("binary"), 256)
    marked = rejected.withColumn(S.QUARANTINE_DIGEST, digest).withColumn(S.QUARANTINE_DAY, F.to_date("loaded_at"))
    if days is None:
        days = [r[0] for r in marked.select(S.QUARANTINE_DAY).distinct().collect()]
    new = marked
    if days:
        new = marked.join(stored_digests(rejected.sparkSession, schema, days), [marked[k].eqNullSafe(F.col(f"__{k}")) for k in key], "left_anti")
    # A text that comes several times in one batch was rejected as often.
    new.select(*columns, S.QUARANTINE_DIGEST, S.QUARANTINE_DAY).write.insertInto(f"{schema}.{QUARANTINE}")


def stored_digests(spark: SparkSession, schema: str, days: Sequence) -> DataFrame:
    """Keys of the quarantined payloads that landed on certain days, under names of their own."""
    day = F.col(S.QUARANTINE_DAY)
    stored = fresh_table(spark, f"{schema}.{QUARANTINE}").filter(day.isin([d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False)))
    return stored.select(*[F.col(k).alias(f"__{k}") for k in (S.QUARANTINE_DAY, S.QUARANTINE_DIGEST)])


def append_audit(metrics: DataFrame, schema: str, duration_seconds: float = 0.0) -> bool:
    """Append one row per symbol; a failure is logged and never stops the load."""
    have = set(metrics.columns)

    def pick(name: str, default: object, dtype: str):
        c = F.coalesce(F.col(name), F.lit(default)) if name in have else F.lit(default)
        return c.cast(dtype)

    processed, loaded = pick("rows_processed", 0, "bigint"), pick("rows_loaded", 0, "bigint")
    rows = metrics.select(
        F.uuid().alias("audit_id"),
        F.lit(S.AUDIT_STEP).alias("pipeline_step"),
        pick("symbol", "N/A", "string").alias("stock_symbol"),
        processed.alias("rows_processed"),
        loaded.alias("rows_inserted"),
        (processed - loaded).alias("rows_rejected"),
        pick("rows_new", 0, "bigint").alias("rows_new"),
        pick("duration_seconds", duration_seconds, "double").alias("duration_seconds"),
        F.current_timestamp().alias("run_timestamp"),
    )
    try:
        rows.write.insertInto(f"{schema}.{AUDIT}")
        return True
    except Exception:
        log.exception("audit metrics were not stored")
        return False
