"""Column expressions shared by the operators.  All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick import schemas as S

_NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:nan|inf|infinity))\z"
_PLAIN_INTEGER = r"^[+-]?\d+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_number(c: Column | str) -> Column:
    """Text that is exactly one number, with signs, exponents, NaN and infinity."""
    return _col(c).rlike(_NUMBER)


def tolerant_double(c: Column | str) -> Column:
    """Text to double; text that is not exactly a number gives null.

    Spark's own cast also takes padded text and Java suffixes (``1.5d``), hence the guard.
    """
    c = _col(c)
    return F.when(is_number(c), c.try_cast("double"))


def tolerant_bigint(c: Column | str) -> Column:
    """Text to bigint; fractions, overflow and other text give null."""
    c = _col(c)
    return F.when(c.rlike(_PLAIN_INTEGER), c.try_cast("bigint"))


def strict_date(c: Column | str, pattern: str = S.DATE_PATTERN) -> Column:
    """Zero-padded date text to date, null when the text is anything else."""
    return F.try_to_timestamp(_col(c), F.lit(pattern)).cast("date")


def is_finite(c: Column | str) -> Column:
    """Null-propagating test for an ordinary double."""
    c = _col(c)
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def to_price(c: Column | str) -> Column:
    """Double to the stored price type, half away from zero; NaN and infinity give null."""
    c = _col(c)
    return F.when(is_finite(c), c.cast(S.PRICE))


def relative_change(value: Column | str, base: Column | str, scale: int = 4) -> Column:
    """``value / base - 1`` on decimals, rounded half away from zero; a zero base gives null."""
    value, base = _col(value), _col(base)
    ratio = value / F.nullif(base, F.lit(0).cast(S.PRICE)) - F.lit(1)
    return F.round(ratio, scale).cast(f"decimal(20,{scale})")


def normalise_ticker(c: Column | str) -> Column:
    return F.trim(F.upper(_col(c)))


def stock_part(symbol: Column | str, parts: int = S.STOCK_PARTS) -> Column:
    """Number of the part of the stocks that a symbol is stored with."""
    return (F.crc32(_col(symbol).cast("binary")) % parts).cast("int")


def symbol_from_path(path: Column | str, part: int = 3) -> Column:
    """Third ``/``-separated part of an object key such as ``bronze/source/SYM/file.json``."""
    return F.split_part(_col(path), F.lit("/"), F.lit(part))


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the joined text of the columns, with nulls kept apart from empty text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(S.KEY_NULL_SENTINEL)) for c in columns]
    return F.md5(F.concat_ws(S.KEY_SEPARATOR, *parts))


def calendar_columns(date: Column | str) -> dict[str, Column]:
    """Calendar attributes of a date: calendar year beside ISO week number."""
    date = _col(date)
    return {
        "year": F.year(date),
        "week_number": F.weekofyear(date),
        "month_name": F.date_format(date, "MMMM"),
        "is_quarter_reporting_month": F.month(date).isin(S.QUARTER_END_MONTHS),
        "is_weekend": F.dayofweek(date).isin(1, 7),
    }


def first_by_rule(c: Column | str, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label of the first group that lists the value; null and unlisted values get the default."""
    c = _col(c)
    rule = None
    for label, members in groups.items():
        hit = c.isin(list(members))
        rule = F.when(hit, label) if rule is None else rule.when(hit, label)
    return F.lit(default) if rule is None else rule.otherwise(F.lit(default))
