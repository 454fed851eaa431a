"""The data contracts of every layer."""

from __future__ import annotations

from candlewick import schemas as S
from candlewick.operators.checks import (
    KEY_KINDS,
    Check,
    accepted_values,
    between,
    has_type,
    matches,
    not_null,
    relationship,
    unique,
    unique_combination,
)

SILVER = "weekly_adjusted_prices"
STAGING = "stg_weekly_adjusted_prices"
FACT = "fact_adjusted_prices"

# --- fixed values: columns, bounds, lists and severities of the contracts ------

SILVER_CONTRACTS: list[Check] = [
    *not_null(SILVER, "price_date", "symbol", "adjusted_close", "volume"),
    has_type(SILVER, "volume", "bigint"),
    unique_combination(SILVER, "price_date", "symbol"),
]

#: Those that a load measures while it writes its new rows.
SILVER_ROW_CONTRACTS = [c for c in SILVER_CONTRACTS if c.kind not in KEY_KINDS]

STAGING_CONTRACTS: list[Check] = [
    *not_null(STAGING, "stock_symbol", "trade_date", "adjusted_close_price", "trade_volume"),
    matches(STAGING, "stock_symbol", S.TICKER_PATTERN).warn(),
    between(STAGING, "adjusted_close_price", 0, row_condition="adjusted_close_price is not null"),
    between(STAGING, "trade_volume", 0, row_condition="trade_volume is not null"),
]

DIMENSION_CONTRACTS: list[Check] = [
    unique("dim_date", "date_id"),
    *not_null("dim_date", "date_id", "week_ending"),
    between("dim_date", "week_ending", "1900-01-01", "2050-12-31"),
    unique("dim_stock", "stock_id"),
    unique("dim_stock", "symbol"),
    *not_null("dim_stock", "stock_id", "symbol"),
    matches("dim_stock", "symbol", S.TICKER_PATTERN).warn(),
    unique("dim_source", "source_id"),
    *not_null("dim_source", "source_id", "source_name", "source_tier", "update_frequency"),
    accepted_values("dim_source", "source_name", ["alpha_vantage", "yahoo_finance", "manual_upload"]).warn(),
    accepted_values("dim_source", "source_tier", ["Gold", "Silver", "Bronze"]),
    accepted_values("dim_source", "update_frequency", ["Daily", "Weekly", "Monthly", "Real-time"]),
    matches("dim_source", "documentation_url", r"^https?://.*"),
]

FACT_CONTRACTS: list[Check] = [
    unique_combination(FACT, "stock_id", "date_id"),
    *not_null(FACT, "stock_id", "date_id", "adjusted_close_price", "volatility_pct"),
    relationship(FACT, "stock_id", "dim_stock", "stock_id"),
    relationship(FACT, "date_id", "dim_date", "date_id"),
    between(FACT, "adjusted_close_price", 0),
    between(FACT, "volatility_pct", 0, 10),
]

# Ranges of the older calendar design, for a date dimension that carries a quarter.
CALENDAR_CONTRACTS: list[Check] = [
    between("dim_date", "year", 2000, 2030),
    between("dim_date", "week_number", 1, 53),
    between("dim_date", "quarter", 1, 4),
]

CONTRACTS: list[Check] = [*STAGING_CONTRACTS, *DIMENSION_CONTRACTS, *FACT_CONTRACTS]
