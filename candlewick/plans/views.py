"""Price series and payloads derived from the sample order tables.

A price row is one product line (brand and type) in one week: it opens at the lowest price of the first
day, closes at the highest of the last day, takes the highest net price of that day as adjusted close, and
the quantity as volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.operators.payload import pack_series

TYPE_CODES = {
    "ECONOMY": "ec",
    "LARGE": "lg",
    "MEDIUM": "md",
    "PROMO": "pr",
    "SMALL": "sm",
    "STANDARD": "st",
}

# Sector grouping for product types; ECONOMY lines have no metadata at all.
TYPE_GROUPS = {
    "Tech & Comm": ["PROMO", "LARGE"],
    "Financial Services": ["SMALL"],
    "Resources & Infrastructure": ["STANDARD"],
}

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _symbol():
    codes = F.create_map(*[F.lit(x) for pair in TYPE_CODES.items() for x in pair])
    code = F.coalesce(F.try_element_at(codes, F.col("p_type")), F.lower("p_type"))
    return F.concat(F.lower(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("b"))), F.lit("."), code)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their symbol."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), _symbol().alias("symbol"))
    return table(spark, folder, "lineitem").join(part, "l_partkey")


def prices(order_lines: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Silver-shaped price rows; ``extra`` columns split a symbol's week further.

    Daily bars first, weekly bars from those.  All aggregate buffers have a fixed width, so both steps
    are generated hash aggregates, and the first one shrinks the rows before they are shuffled.  Prices
    become decimals after that, once per bar instead of once per line.
    """
    price = F.col("l_extendedprice")
    net = price * (1 - F.col("l_discount"))
    daily = order_lines.groupBy("symbol", F.col("l_shipdate").cast("date").alias("day"), *extra).agg(
        F.min(price).alias("low"),
        F.max(price).alias("high"),
        F.max(net).alias("net"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )
    friday = F.date_add(F.date_trunc("week", "day").cast("date"), 4)
    return (
        daily.groupBy("symbol", friday.alias("price_date"), *extra)
        .agg(
            F.min_by("low", "day").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("high", "day").alias("close"),
            F.max_by("net", "day").alias("adjusted_close"),
            F.sum("quantity").alias("volume"),
        )
        .select(
            "price_date",
            "symbol",
            *[F.col(name).cast(S.PRICE).alias(name) for name in S.PRICE_COLUMNS],
            "volume",
            F.lit("2002-01-01 00:00:00").cast("timestamp").alias("_ingestion_timestamp"),
            F.lit(S.DATA_SOURCE).alias("_data_source"),
            F.lit("2002-01-01").cast("date").alias("_processing_date"),
            *extra,
        )
    )


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return prices(lines(spark, folder))


def seed(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata with many rows per symbol, and none for ECONOMY lines."""
    return (
        table(spark, folder, "part")
        .filter(F.col("p_type") != "ECONOMY")
        .select(
            F.upper(_symbol()).alias("symbol"),
            F.col("p_name").alias("company_name"),
            F.col("p_type").alias("sector"),
            F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("industry"),
        )
    )


def price_payloads(rows: DataFrame) -> DataFrame:
    """Price rows packed as one payload per symbol and year."""
    fields = {field: F.col(name) for field, name in S.SERIES_FIELDS.items()}
    packed = pack_series(rows.withColumn("_year", F.year("price_date")), ["symbol", "_year"], fields)
    return packed.select("symbol", "payload")


# Payload text of an event, in SQL that both engines read.  The event type and the number in its
# properties decide which kind of response it stands for.
_SERIES = S.SERIES_KEY
_ROW = (
    '\'{"1. open":"\' || v || \'","2. high":"\' || v || \'","3. low":"\' || v || \'","4. close":"\' || v'
    ' || \'","5. adjusted close":"\' || v || \'","6. volume":"\' || k || \'"}\''
)
_ONE_DAY = f'''('{{"{_SERIES}":{{"' || day || '":' || {_ROW} || '}}}}')'''
# Another row under the same date: it comes first, so it does not count.
_OLD = f"replace({_ROW}, '\"1. open\":\"', '\"1. open\":\"9')"
EVENT_PAYLOAD_SQL = f"""
CASE
  WHEN event_type = 'click' THEN '{{"{_SERIES}":{{"' || day || '":' || {_ROW} || '}}}}'
  WHEN event_type = 'purchase' AND k < 20 THEN '{{"{_SERIES}":{{}}}}'
  WHEN event_type = 'purchase' AND k < 40 THEN '{{"{_SERIES}":{{"' || replace(day, '-', '/') || '":' || {_ROW} || '}}}}'
  WHEN event_type = 'purchase' AND k < 60 THEN '{{"{_SERIES}":{{"' || day || '":{{"1. open":"' || v || '","4. close":"' || v || '"}}}}}}'
  WHEN event_type = 'purchase' AND k < 80 THEN '{{"{_SERIES}":{{"' || day || '":' || replace({_ROW}, '"4. close":"', '"4. close":"abc') || '}}}}'
  WHEN event_type = 'purchase' THEN '{{"{_SERIES}":{{"' || day || '":' || replace(replace({_ROW}, '"1. open":"', '"1. open":"-'), '"2. high":"', '"2. high":"x') || '}}}}'
  WHEN event_type = 'error' THEN '{{"Error Message":"bad user ' || user_id || '"}}'
  WHEN event_type = 'signup' AND k < 50 THEN '{{"Note":"our standard API call frequency is 5 per minute"}}'
  WHEN event_type = 'signup' THEN '{{"Note":"welcome","{_SERIES}":{{"' || day || '":' || {_ROW} || '}}}}'
  WHEN event_type = 'view' AND k < 33 THEN '{{"Information":"maintenance"}}'
  WHEN event_type = 'view' AND k < 50 THEN '{{bad ' || v
  WHEN event_type = 'view' AND k < 56 THEN {_ONE_DAY} || {_ONE_DAY}
  WHEN event_type = 'view' AND k < 62 THEN {_ONE_DAY} || ' x}}'
  WHEN event_type = 'view' AND k < 68 THEN '{{"{_SERIES}":null}}'
  WHEN event_type = 'view' AND k < 74 THEN '{{"{_SERIES}":"' || v || '"}}'
  WHEN event_type = 'view' AND k < 80 THEN '{{"{_SERIES}":{{"2001-01-05":' || {_ROW} || ',"2001-01-12":null}}}}'
  WHEN event_type = 'view' AND k < 86 THEN '{{"{_SERIES}":{{"' || day || '":' || {_OLD} || ',"' || day || '":' || {_ROW} || '}}}}'
  WHEN event_type = 'view' AND k < 92 THEN '{{"{_SERIES}":{{"' || day || '":' || replace({_ROW}, '{{', '{{"1. open":"7","6. volume":"9",') || '}}}}'
  WHEN event_type = 'view' AND k < 94 THEN {_ONE_DAY} || '] x'
  WHEN event_type = 'view' AND k < 96 THEN {_ONE_DAY} || '],[1'
  WHEN event_type = 'view' AND k < 98 THEN {_ONE_DAY} || '}} ]'
  ELSE '{{}}'
END"""


def event_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per event: event_id, symbol, payload."""
    fields = table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("date").cast("string").alias("day"),
        F.col("value").cast("decimal(15,4)").cast("string").alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    return fields.select(
        "event_id", F.concat(F.lit("U"), "user_id").alias("symbol"), F.expr(EVENT_PAYLOAD_SQL).alias("payload")
    )
