"""The tracked universe: a JSON list of symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas as S


def universe(spark: SparkSession, symbols_json: str = S.DEFAULT_UNIVERSE) -> DataFrame:
    """One row per listed symbol."""
    names = F.from_json(F.lit(symbols_json), "array<string>")
    return spark.range(1).select(F.explode(names).alias("symbol"))


def request_fields(symbols: DataFrame, base_url: str, function: str, api_key: str) -> DataFrame:
    """Request description of each symbol."""
    params = {"function": F.lit(function), "apikey": F.lit(api_key), "symbol": F.col("symbol")}
    return symbols.select(
        "symbol",
        F.lit(base_url).alias("base_url"),
        F.create_map(*[part for name, c in params.items() for part in (F.lit(name), c)]).alias("api_params"),
    )


def in_universe(df: DataFrame, symbols: DataFrame, column: str = "symbol") -> DataFrame:
    """Rows whose symbol is tracked."""
    return df.join(symbols.select(F.col("symbol").alias(column)), column, "left_semi")
