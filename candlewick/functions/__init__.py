from .columns import (
    calendar_columns,
    first_by_rule,
    is_finite,
    is_number,
    normalise_ticker,
    relative_change,
    stock_part,
    strict_date,
    surrogate_key,
    symbol_from_path,
    to_price,
    tolerant_bigint,
    tolerant_double,
)

__all__ = [
    "calendar_columns",
    "first_by_rule",
    "is_finite",
    "is_number",
    "normalise_ticker",
    "relative_change",
    "stock_part",
    "strict_date",
    "surrogate_key",
    "symbol_from_path",
    "to_price",
    "tolerant_bigint",
    "tolerant_double",
]
