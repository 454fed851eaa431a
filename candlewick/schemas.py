"""Table schemas and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# These must equal the source system's values for results to agree.

SERIES_KEY = "Weekly Adjusted Time Series"
ERROR_KEY = "Error Message"
NOTE_KEY = "Note"
INFO_KEY = "Information"
RATE_LIMIT_PHRASE = "API call frequency"
RATE_LIMIT_TEXT = "Alpha Vantage Rate Limit Exceeded (5 calls/min or 500/day)."

DATE_PATTERN = "yyyy-MM-dd"
SERIES_FIELDS = {
    "1. open": "open",
    "2. high": "high",
    "3. low": "low",
    "4. close": "close",
    "5. adjusted close": "adjusted_close",
    "6. volume": "volume",
}
REQUIRED_FIELDS = ["1. open", "4. close", "6. volume"]
NUMBERED_FIELD = r"^\d\.\s.*$"

DATA_SOURCE = "alpha_vantage"
DEFAULT_UNIVERSE = '["IBM", "MSFT"]'
AUDIT_STEP = "transform_load_silver"
TICKER_PATTERN = r"^[A-Z0-9\.]+$"
MAX_SYMBOL_LENGTH = 10
MAX_SOURCE_LENGTH = 50

# Public surrogate-key convention of the dbt_utils package.
KEY_NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

SECTOR_GROUPS = {
    "Tech & Comm": ["Technology", "Communication Services"],
    "Financial Services": ["Financials", "Real Estate"],
    "Resources & Infrastructure": ["Energy", "Utilities", "Basic Materials"],
}
DEFAULT_SECTOR_GROUP = "Consumer & Others"
UNKNOWN_COMPANY = "Unknown Company"
UNKNOWN_SECTOR = "Unknown Sector"
UNKNOWN_INDUSTRY = "Unknown Industry"

QUARTER_END_MONTHS = [3, 6, 9, 12]
ANOMALY_THRESHOLD = 2.0

SOURCE_ROW = {
    "source_name": "alpha_vantage",
    "data_content": "Weekly Adjusted Prices",
    "source_tier": "Gold",
    "update_frequency": "Weekly",
    "api_version": "v1",
    "documentation_url": "https://www.alphavantage.co/documentation/",
    "extraction_method": "REST API",
}

STOCK_METADATA = [
    ("IBM", "International Business Machines", "Technology", "Information Technology Services"),
    ("MSFT", "Microsoft Corporation", "Technology", "Software—Infrastructure"),
    ("NVDA", "NVIDIA Corporation", "Technology", "Semiconductors"),
    ("GOOGL", "Alphabet Inc.", "Communication Services", "Internet Content"),
    ("AAPL", "Apple Inc.", "Technology", "Consumer Electronics"),
    ("AMZN", "Amazon.com Inc.", "Consumer Discretionary", "Internet Retail"),
    ("V", "Visa Inc.", "Financial Services", "Credit Services"),
    ("MA", "Mastercard Incorporated", "Financial Services", "Credit Services"),
    ("TSCO.LON", "Tesco PLC", "Consumer Defensive", "Grocery Stores"),
    ("SHOP.TRTO", "Shopify Inc.", "Technology", "Software—Application"),
]

# --- schemas ----------------------------------------------------------------

PRICE = T.DecimalType(15, 4)
PRICE_COLUMNS = ["open", "high", "low", "close", "adjusted_close"]
SILVER_KEY = ["price_date", "symbol"]

SEED_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("symbol", "company_name", "sector", "industry")]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("price_date", T.DateType(), False),
        T.StructField("symbol", T.StringType(), False),
        *[T.StructField(name, PRICE) for name in PRICE_COLUMNS],
        T.StructField("volume", T.LongType()),
        T.StructField("_ingestion_timestamp", T.TimestampType()),
        T.StructField("_data_source", T.StringType()),
        T.StructField("_processing_date", T.DateType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.StringType(), False),
        T.StructField("pipeline_step", T.StringType(), False),
        T.StructField("stock_symbol", T.StringType(), False),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_new", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("run_timestamp", T.TimestampType()),
    ]
)


QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("reject_reason", T.StringType(), False),
        T.StructField("payload", T.StringType()),
    ]
)

# What the loads touched, until gold has taken it over.
CHANGES_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType(), False),
        T.StructField("price_year", T.IntegerType(), False),
        T.StructField("symbol", T.StringType(), False),
    ]
)
REFRESHES_SCHEMA = T.StructType([T.StructField("load_id", T.StringType(), False)])

# Rejected payloads are stored by the day of their landing; the digest is their key within it.
QUARANTINE_DAY, QUARANTINE_DIGEST = "landed_on", "digest"

# Silver is stored by this year of its date, which the schema above does not show.
SILVER_PART = "price_year"
# Staging, fact and moments are stored by year and by a part of the stocks; the number of parts is a choice of layout.
GOLD_PARTS = ["price_year", "stock_part"]
STOCK_PARTS = 4


def payload_schema(series_key: str = SERIES_KEY) -> T.StructType:
    """Payload document: optional text markers and a map date -> field -> text."""
    fields = T.MapType(T.StringType(), T.StringType())
    return T.StructType(
        [
            T.StructField(ERROR_KEY, T.StringType()),
            T.StructField(NOTE_KEY, T.StringType()),
            T.StructField(INFO_KEY, T.StringType()),
            T.StructField(series_key, T.MapType(T.StringType(), fields)),
        ]
    )
