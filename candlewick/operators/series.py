"""Payload series to typed price rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.functions import strict_date, to_price, tolerant_bigint, tolerant_double

from .payload import ROWS, dated, quality_rule

_TYPED = ["price_date", *S.SERIES_FIELDS.values()]


def flatten(parsed: DataFrame, keep: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """One row per date of each parsed payload, every value still text.

    A payload without the series gives no rows.  Unknown fields are dropped.
    """
    return dated(parsed, keep).select(
        *keep,
        F.col("day").alias("price_date"),
        *[F.col("row")[field].alias(name) for field, name in S.SERIES_FIELDS.items()],
    )


def tolerant_casts(raw: DataFrame) -> DataFrame:
    """Text rows to double and bigint, failures to null."""
    casts = {name: tolerant_double(name) for name in S.PRICE_COLUMNS}
    return raw.withColumns(
        {**casts, "volume": tolerant_bigint("volume"), "price_date": strict_date("price_date")}
    )


def _is_kept():
    return quality_rule(F.col("open"), F.col("close"), F.col("volume"))


def typed_rows(screened: DataFrame, keep: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """All typed rows of the accepted payloads, with ``is_kept`` from the quality rule.

    A payload that is rejected or empty stays as one row without a date, so that this one frame also
    answers how many rows came in and what was turned away.
    """
    accepted = F.when(F.col("reject_reason").isNull(), F.col(ROWS))
    rows = screened.select(*keep, "reject_reason", F.explode_outer(accepted).alias("_row"))
    flat = rows.select(*keep, "reject_reason", *[F.col("_row")[name].alias(name) for name in _TYPED])
    return flat.withColumn("is_kept", _is_kept())


def kept_rows(typed: DataFrame) -> DataFrame:
    """Rows that pass the quality rule."""
    return typed.filter(_is_kept())


def standardise(
    typed: DataFrame,
    run_time: str,
    data_source: str = S.DATA_SOURCE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Quality filter, stored price type, lineage columns and the fixed column order.

    ``run_time`` is UTC text and an argument, so that a repeated run gives the same rows.
    """
    return (
        kept_rows(typed)
        .withColumns(
            {
                **{name: to_price(name) for name in S.PRICE_COLUMNS},
                "_ingestion_timestamp": F.lit(f"{run_time} UTC").cast("timestamp"),
                "_data_source": F.coalesce(F.lit(data_source), F.lit(S.DATA_SOURCE)),
                "_processing_date": F.lit(run_time).cast("timestamp_ntz").cast("date"),
            }
        )
        .select(*S.SILVER_SCHEMA.names, *keep)
    )


def load_counts(typed: DataFrame, inserted: DataFrame | None = None) -> DataFrame:
    """Per symbol: rows in the accepted payloads, rows kept, rows new to the table.

    A symbol whose payloads are empty, or lose every row, is there with zeros; one whose payloads were
    all rejected is not.
    """
    counts = (
        typed.groupBy("symbol")
        .agg(
            F.count_if(F.col("reject_reason").isNull()).alias("_accepted"),
            F.count("price_date").alias("rows_processed"),
            F.count_if("is_kept").alias("rows_loaded"),
        )
        .filter(F.col("_accepted") > 0)
        .drop("_accepted")
    )
    if inserted is None:
        return counts
    new = inserted.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_new"))
    return counts.join(new, "symbol", "left").na.fill(0, ["rows_new"])
