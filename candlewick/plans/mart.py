"""Questions put to the star: the joined mart, selections, indicators and chart data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.operators.stats import grouped_quantiles, merged_moments, share_of_total, with_zscore

from .gold import PART, PRICE_VALUE, YEAR, Gold


def gold_mart(gold: Gold, ordered: bool = False) -> DataFrame:
    """Fact joined to stock and week.

    A stored fact lies by year and stock part, which its dimensions know: joined on these as well, what is asked of a
    dimension prunes the partitions of the fact.
    """
    stock = gold.dim_stock.select("stock_id", "symbol", "company_name", "sector_group", *_also(gold.dim_stock, PART))
    week = gold.dim_date.select("date_id", F.col("week_ending").alias("date"), F.col("year").alias(YEAR))
    mart = (
        gold.fact.join(stock, ["stock_id", *_also(gold.fact, PART)])
        .join(week, ["date_id", *_also(gold.fact, YEAR)])
        .select(
            "date",
            "symbol",
            "company_name",
            "sector_group",
            "adjusted_close_price",
            "weekly_return_pct",
            "volatility_pct",
            "trade_volume",
        )
    )
    # The symbol lets the range sort split a week that has many rows.
    return mart.orderBy("date", "symbol") if ordered else mart


def _also(df: DataFrame, column: str) -> list[str]:
    return [column] if column in df.columns else []


def select_rows(
    mart: DataFrame,
    sectors: Sequence[str] | None = None,
    symbols: Sequence[str] | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Rows of the chosen sector groups, symbols and dates (ends included); an empty choice keeps nothing."""
    if since is not None:
        mart = mart.filter(F.col("date") >= F.lit(since).cast("date"))
    if until is not None:
        mart = mart.filter(F.col("date") <= F.lit(until).cast("date"))
    if sectors is not None:
        mart = mart.filter(F.col("sector_group").isin(list(sectors)))
    if symbols is not None:
        mart = mart.filter(F.col("symbol").isin(list(symbols)))
    return mart


def stored_zscores(gold: Gold) -> DataFrame:
    """The mart of a stored build with z-scores of the price, from the stored moments of all loads."""
    whole = merged_moments(gold.moments, "stock_id").join(gold.dim_stock.select("stock_id", "symbol"), "stock_id")
    return with_zscore(gold_mart(gold), "symbol", PRICE_VALUE, stored=whole.drop("stock_id"))


def _is_anomaly(threshold: float):
    return F.abs("z_score") > F.lit(threshold)


def anomaly_count(
    mart: DataFrame, key: str = "symbol", value: str = "adjusted_close_price", threshold: float = S.ANOMALY_THRESHOLD
) -> DataFrame:
    """Anomalies per key: rows whose z-score is beyond the threshold."""
    scored = with_zscore(mart, key, value)
    return scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(_is_anomaly(threshold)).alias("anomalies")
    )


def kpis(mart: DataFrame, threshold: float = S.ANOMALY_THRESHOLD) -> DataFrame:
    """One row: symbols, mean volatility in percent, mean return, volume in millions, anomalies."""
    zero = F.lit(0.0)
    return with_zscore(mart, "symbol", "adjusted_close_price").agg(
        F.count_distinct("symbol").alias("tickers"),
        (F.coalesce(F.avg(F.col("volatility_pct").cast("double")), zero) * 100).alias("avg_volatility_pct"),
        F.coalesce(F.avg(F.col("weekly_return_pct").cast("double")), zero).alias("avg_weekly_return"),
        (F.coalesce(F.sum("trade_volume"), F.lit(0)).cast("double") / 1e6).alias("total_volume_millions"),
        F.count_if(_is_anomaly(threshold)).alias("anomalies"),
    )


def price_trend(mart: DataFrame) -> DataFrame:
    """Price line of each symbol."""
    return mart.select("date", "symbol", "company_name", "adjusted_close_price").orderBy("symbol", "date")


def chart_series(mart: DataFrame, bins: int = 100) -> DataFrame:
    """Price line of each symbol, thinned for a chart: of each time bin the first, last, lowest and highest row.

    Bins divide the days from the first to the last of all rows evenly.  Ties go to the earlier week.  A chart gets at most
    four rows per symbol and bin whatever the length of the line, and each of its extremes and steps.
    """
    ends = mart.agg(F.min("date").alias("low"), F.max("date").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    days = F.datediff(F.col("date"), low)
    width = F.datediff(high, low) + 1
    price, early = F.col("adjusted_close_price"), -F.unix_date("date")
    row = F.struct("date", "adjusted_close_price")
    binned = mart.filter("date IS NOT NULL").withColumn("bin", F.floor(days * bins / width).cast("int"))
    corners = binned.groupBy("symbol", "bin").agg(
        F.min_by(row, "date").alias("first"),
        F.max_by(row, "date").alias("last"),
        F.min_by(row, F.struct(price, F.col("date"))).alias("lowest"),
        F.max_by(row, F.struct(price, early)).alias("highest"),
    )
    kept = F.explode(F.array_distinct(F.array("first", "last", "lowest", "highest")))
    return corners.select("symbol", "bin", kept.alias("row")).select("symbol", "bin", "row.*")


def volatility_spread(mart: DataFrame) -> DataFrame:
    """Distribution of volatility per symbol, for box plots."""
    return grouped_quantiles(mart, "symbol", "volatility_pct")


def volume_share(mart: DataFrame) -> DataFrame:
    """Traded volume per sector group and its share."""
    return share_of_total(mart, "sector_group", "trade_volume", "volume_share")


def newest_first(mart: DataFrame) -> DataFrame:
    """The raw table, newest week first."""
    return mart.orderBy(F.desc("date"), "symbol")
