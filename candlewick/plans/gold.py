"""Silver to the star schema: staging, three dimensions and the fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.functions import (
    calendar_columns,
    first_by_rule,
    normalise_ticker,
    relative_change,
    stock_part,
    surrogate_key,
)
from candlewick.operators.checks import raise_on_error, run_checks
from candlewick.operators.ranking import first_per_key
from candlewick.operators.stats import moments
from candlewick.sources.scratch import discard, materialise
from candlewick.sources.tables import (
    SILVER,
    append_rows,
    build_version,
    current_version,
    fresh_table,
    mark_refreshed,
    overwrite_partitions,
    pending_changes,
    publish,
)

from .contracts import CONTRACTS, FACT, SILVER_CONTRACTS, STAGING

MOMENTS = "stock_moments"
PRICE_VALUE = "adjusted_close_price"
YEAR, PART = S.GOLD_PARTS


def build_staging(silver: DataFrame) -> DataFrame:
    """Silver under its modelling names, without rows that have no adjusted close."""
    return silver.filter(F.col("adjusted_close").isNotNull()).select(
        normalise_ticker("symbol").alias("stock_symbol"),
        F.col("price_date").alias("trade_date"),
        *[F.col(name).alias(f"{name}_price") for name in S.PRICE_COLUMNS],
        F.col("volume").alias("trade_volume"),
        "_ingestion_timestamp",
        "_processing_date",
        F.current_timestamp().alias("dbt_load_timestamp"),
    )


def build_dim_date(staging: DataFrame, date: str = "trade_date") -> DataFrame:
    weeks = staging.select(F.col(date).alias("week_ending")).filter("week_ending IS NOT NULL").distinct()
    return weeks.select(
        surrogate_key("week_ending").alias("date_id"),
        "week_ending",
        *[c.alias(name) for name, c in calendar_columns("week_ending").items()],
        F.current_timestamp().alias("created_at"),
    )


def build_dim_stock(
    staging: DataFrame,
    seed: DataFrame,
    sector_groups: Mapping[str, Sequence[str]] = S.SECTOR_GROUPS,
    default_group: str = S.DEFAULT_SECTOR_GROUP,
) -> DataFrame:
    """Distinct symbols with their metadata.

    Repeated seed rows of a symbol are settled by the order of their other columns.
    """
    symbols = staging.select(F.col("stock_symbol").alias("symbol")).distinct()
    metadata = first_per_key(seed, ["symbol"], ["company_name", "sector", "industry"])
    known = F.col("company_name").isNotNull() & (F.col("company_name") != S.UNKNOWN_COMPANY)
    return symbols.join(metadata, "symbol", "left").select(
        surrogate_key("symbol").alias("stock_id"),
        "symbol",
        F.coalesce("company_name", F.lit(S.UNKNOWN_COMPANY)).alias("company_name"),
        F.coalesce("sector", F.lit(S.UNKNOWN_SECTOR)).alias("sector"),
        F.coalesce("industry", F.lit(S.UNKNOWN_INDUSTRY)).alias("industry"),
        first_by_rule("sector", sector_groups, default_group).alias("sector_group"),
        F.coalesce(known, F.lit(False)).alias("has_metadata"),
        F.lit(True).alias("is_active"),
        F.current_timestamp().alias("created_at"),
    )


def build_dim_source(spark: SparkSession, row: Mapping[str, str] = S.SOURCE_ROW) -> DataFrame:
    described = spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()])
    return described.select(
        surrogate_key("source_name", "api_version").alias("source_id"),
        *row,
        F.current_timestamp().alias("created_at"),
    )


def build_fact(
    staging: DataFrame,
    dim_stock: DataFrame,
    dim_date: DataFrame,
    dim_source: DataFrame,
    source_name: str = S.DATA_SOURCE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per stock and week with return, range and volatility measures; ``keep`` columns of staging stay.

    The dimensions should be written tables: their real size then decides how each is joined.  The
    source is one constant for the whole build, so its key is a scalar subquery: two rows under one name
    stop the build, and none leaves the fact empty, as an inner join would.
    """
    source_id = dim_source.filter(F.col("source_name") == source_name).select("source_id").scalar()
    joined = (
        staging.join(dim_stock.select("stock_id", F.col("symbol").alias("stock_symbol")), "stock_symbol")
        .join(dim_date.select("date_id", F.col("week_ending").alias("trade_date")), "trade_date")
        .withColumn("source_id", source_id)
        .filter(F.col("source_id").isNotNull())
    )
    measures = {name: F.round(name, 4).cast(S.PRICE) for name in ("open_price", "high_price", "low_price")}
    gain = F.col("adjusted_close_price") - F.col("open_price")
    spread = F.col("high_price") - F.col("low_price")
    return joined.select(
        "stock_id",
        "date_id",
        "source_id",
        *[c.alias(name) for name, c in measures.items()],
        F.round("adjusted_close_price", 4).cast(S.PRICE).alias("adjusted_close_price"),
        "trade_volume",
        F.round(gain, 4).cast("decimal(16,4)").alias("weekly_return_abs"),
        relative_change("adjusted_close_price", "open_price").alias("weekly_return_pct"),
        F.round(spread, 4).cast("decimal(16,4)").alias("trading_range_abs"),
        relative_change("high_price", "low_price").alias("volatility_pct"),
        F.col("_ingestion_timestamp").alias("load_timestamp"),
        F.lit(source_name).alias("source_model"),
        *keep,
    )


def with_parts(staging: DataFrame) -> DataFrame:
    """Staging with the year and the part of the stocks that it and the fact are stored by."""
    return staging.withColumns({YEAR: F.year("trade_date"), PART: stock_part("stock_symbol")})


def clustered(df: DataFrame, stock: str) -> DataFrame:
    """Rows in the order of their storage: a partition in few files, each with a range of the stocks."""
    return df.repartitionByRange(YEAR, PART, stock).sortWithinPartitions(YEAR, PART, stock)


def build_moments(fact: DataFrame, value: str = PRICE_VALUE) -> DataFrame:
    """Number, mean and squared deviations of a value by stock and year; ``merged_moments`` joins the years."""
    return moments(fact, ["stock_id", YEAR, PART], value).select("stock_id", "n", "mean", "m2", YEAR, PART)


@dataclass(frozen=True)
class Gold:
    """The model tables of one build; stored ones have the moments of their prices beside them."""

    staging: DataFrame
    dim_date: DataFrame
    dim_stock: DataFrame
    dim_source: DataFrame
    fact: DataFrame
    moments: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {
            STAGING: self.staging,
            "dim_date": self.dim_date,
            "dim_stock": self.dim_stock,
            "dim_source": self.dim_source,
            FACT: self.fact,
        }


def build_gold(
    silver: DataFrame,
    seed: DataFrame,
    schema: str | None = None,
    sector_groups: Mapping[str, Sequence[str]] = S.SECTOR_GROUPS,
    keep_fact: bool = True,
) -> Gold:
    """Build every model in dependency order, each from the written tables before it.

    With ``schema`` the models are catalog tables, published when all of them are built; otherwise they live in
    scratch.  ``keep_fact=False`` leaves the fact as a plan for a caller that reads it once.
    """
    if schema is not None:
        return _build_stored(silver, seed, schema, sector_groups)
    staging = materialise(build_staging(silver), STAGING)
    dim_date = materialise(build_dim_date(staging), "dim_date")
    dim_stock = materialise(build_dim_stock(staging, seed, sector_groups), "dim_stock")
    dim_source = build_dim_source(silver.sparkSession)
    fact = build_fact(staging, dim_stock, dim_date, dim_source)
    if keep_fact:
        fact = materialise(fact, FACT)
    return Gold(staging, dim_date, dim_stock, dim_source, fact)


def read_gold(spark: SparkSession, schema: str) -> Gold:
    """The published models."""
    names = (STAGING, "dim_date", "dim_stock", "dim_source", FACT, MOMENTS)
    return Gold(*[fresh_table(spark, f"{schema}.{name}") for name in names])


def _build_stored(silver: DataFrame, seed: DataFrame, schema: str, sector_groups: Mapping[str, Sequence[str]]) -> Gold:
    spark, built = silver.sparkSession, {}

    def store(df: DataFrame, name: str, parts: Sequence[str] = ()) -> DataFrame:
        built[name] = build_version(df, schema, name, parts)
        return spark.table(built[name])

    staging = store(clustered(with_parts(build_staging(silver)), "stock_symbol"), STAGING, S.GOLD_PARTS)
    dim_date = store(build_dim_date(staging), "dim_date")
    dim_stock = store(_parted_stocks(staging, seed, sector_groups), "dim_stock")
    dim_source = store(build_dim_source(spark), "dim_source")
    fact = build_fact(staging, dim_stock, dim_date, dim_source, keep=S.GOLD_PARTS)
    fact = store(clustered(fact, "stock_id"), FACT, S.GOLD_PARTS)
    store(build_moments(fact), MOMENTS, S.GOLD_PARTS)
    publish(spark, schema, built)
    return read_gold(spark, schema)


def _parted_stocks(staging: DataFrame, seed: DataFrame, sector_groups: Mapping[str, Sequence[str]]) -> DataFrame:
    return build_dim_stock(staging, seed, sector_groups).withColumn(PART, stock_part("symbol"))


def refresh_gold(
    spark: SparkSession, schema: str, seed: DataFrame, sector_groups: Mapping[str, Sequence[str]] = S.SECTOR_GROUPS
) -> Gold:
    """Bring the stored models up to date with the loads since the last refresh; the first one builds them.

    Staging, fact and moments are rebuilt from silver for the years and stock parts that those loads touched, and replace
    their partitions; dimensions gain the keys they lack.  Running it again, also after a failure half way, gives
    the same tables, and they equal a full build, which is what a changed seed asks for.
    """
    used: list[str] = []
    changes = materialise(pending_changes(spark, schema), "silver-changes", used)
    silver = fresh_table(spark, f"{schema}.{SILVER}")
    if current_version(spark, schema, FACT) is None:
        gold = build_gold(silver.drop(S.SILVER_PART), seed, schema, sector_groups)
        mark_refreshed(changes, schema)
        discard(spark, used)
        return gold
    if changes.isEmpty():
        discard(spark, used)
        return read_gold(spark, schema)
    versions = {name: current_version(spark, schema, name) for name in (STAGING, "dim_date", "dim_stock", "dim_source", FACT, MOMENTS)}
    touched = changes.select(F.col("price_year").alias(YEAR), stock_part(normalise_ticker("symbol")).alias(PART)).distinct()
    touched = materialise(touched, "touched-parts", used)
    # At most one per calendar year; they prune the partitions of silver and of the models.
    years = [r[0] for r in touched.select(YEAR).distinct().collect()]

    def of_parts(df: DataFrame) -> DataFrame:
        return df.filter(F.col(YEAR).isin(years)).join(touched, S.GOLD_PARTS, "left_semi")

    def replace(df: DataFrame, name: str, stock: str) -> DataFrame:
        table = fresh_table(spark, versions[name])
        overwrite_partitions(clustered(df, stock).select(*table.columns), versions[name])
        return of_parts(fresh_table(spark, versions[name]))

    def extend(df: DataFrame, name: str, key: str) -> DataFrame:
        table = fresh_table(spark, versions[name])
        new = materialise(df.join(table.select(key), key, "left_anti").select(*table.columns), f"new-{name}", used)
        append_rows(new, versions[name])
        return fresh_table(spark, versions[name])

    rows = with_parts(build_staging(silver.filter(F.col(S.SILVER_PART).isin(years)).drop(S.SILVER_PART)))
    staging = replace(of_parts(rows), STAGING, "stock_symbol")
    dim_date = extend(build_dim_date(staging), "dim_date", "week_ending")
    dim_stock = extend(_parted_stocks(staging, seed, sector_groups), "dim_stock", "symbol")
    fact = build_fact(staging, dim_stock, dim_date, fresh_table(spark, versions["dim_source"]), keep=S.GOLD_PARTS)
    fact = replace(fact, FACT, "stock_id")
    replace(build_moments(fact), MOMENTS, "stock_id")
    mark_refreshed(changes, schema)
    discard(spark, used)
    return read_gold(spark, schema)


def check_layers(spark: SparkSession, schema: str, raise_errors: bool = False) -> DataFrame:
    """Report of the contracts of silver and of the published models."""
    tables = {SILVER: fresh_table(spark, f"{schema}.{SILVER}"), **read_gold(spark, schema).tables()}
    report = materialise(run_checks(tables, [*SILVER_CONTRACTS, *CONTRACTS]), "contract-report")
    if raise_errors:
        raise_on_error(report)
    return report


def check_gold(gold: Gold, raise_errors: bool = False) -> DataFrame:
    """Report of all contracts, after all models are built."""
    report = run_checks(gold.tables(), CONTRACTS)
    if raise_errors:
        report = materialise(report, "contract-report")
        raise_on_error(report)
    return report
