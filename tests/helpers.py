"""Small payloads for the tests."""

import json

SERIES = "Weekly Adjusted Time Series"
GOOD = {
    "1. open": "40.25",
    "2. high": "47.5",
    "3. low": "38",
    "4. close": "46.125",
    "5. adjusted close": "46.02",
    "6. volume": "731",
    "7. dividend amount": "0.35",
}
NEGATIVE = {
    "1. open": "3.5",
    "2. high": "3.75",
    "3. low": "2",
    "4. close": "-0.01",
    "5. adjusted close": "3",
    "6. volume": "12",
}


def payload(days, **extra):
    return json.dumps({**extra, SERIES: days})


def without(field, row=GOOD):
    return {k: v for k, v in row.items() if k != field}


def frame(spark, *rows):
    """(symbol, payload) rows; path and time of the file follow their order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(i, s, p) for i, (s, p) in enumerate(rows)], "n int, symbol string, payload string"
    )
    return df.select(
        "symbol",
        "payload",
        F.timestamp_seconds(F.col("n")).alias("loaded_at"),
        F.format_string("file-%03d", "n").alias("file_path"),
    )
