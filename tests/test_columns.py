import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick import functions as C
from candlewick import schemas as S


def values(spark, expr, items, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {dtype}")
    return [r[0] for r in df.select(expr.alias("x"), "i").orderBy("i").drop("i").collect()]


def test_numbers_are_read_without_the_leniency_of_a_cast(spark):
    items = ["12", "-1.5", "+2.", ".5", "1e3", " 12 ", "1.5d", "abc", "", None, "12,5"]
    assert values(spark, C.tolerant_double("v"), items) == [12, -1.5, 2, 0.5, 1000, *[None] * 6]
    special = values(spark, C.tolerant_double("v"), ["NaN", "inf", "-Infinity"])
    assert special[0] != special[0] and special[1:] == [float("inf"), float("-inf")]


def test_fractions_are_no_integers(spark):
    items = ["1000", "-3", "1000.5", "1e3", "99999999999999999999", "x", None]
    assert values(spark, C.tolerant_bigint("v"), items) == [1000, -3, *[None] * 5]


def test_dates_need_zero_padding(spark):
    items = ["2023-10-27", "2023-1-5", "2023-13-40", "2023", "2023-10-27 10:00", None]
    assert values(spark, C.strict_date("v"), items) == [dt.date(2023, 10, 27), *[None] * 5]


def test_prices_round_half_away_from_zero_and_have_no_infinity(spark):
    items = [1.00005, -1.00005, float("nan"), float("inf"), None]
    assert values(spark, C.to_price("v"), items, "double") == [Decimal("1.0001"), Decimal("-1.0001"), *[None] * 3]


def test_relative_change(spark):
    df = spark.createDataFrame(
        [(Decimal("158"), Decimal("151")), (Decimal("154"), Decimal("152")), (Decimal("1"), Decimal("0"))],
        "a decimal(15,4), b decimal(15,4)",
    )
    got = [r[0] for r in df.select(C.relative_change("a", "b")).collect()]
    assert got == [Decimal("0.0464"), Decimal("0.0132"), None]


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=1, max_size=30
    )
)
def test_relative_change_is_exact(spark, pairs):
    rows = [(Decimal(a).scaleb(-4), Decimal(b).scaleb(-4)) for a, b in pairs]
    df = spark.createDataFrame(rows, "a decimal(15,4), b decimal(15,4)")
    got = [r[0] for r in df.select(C.relative_change("a", "b")).collect()]
    for (a, b), x in zip(pairs, got, strict=True):
        sign = 1 if a >= b else -1
        assert int(x.scaleb(4)) == sign * ((20000 * abs(a - b) + b) // (2 * b))


def test_surrogate_key_is_md5_of_joined_text(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("", 2)], "s string, n int")
    got = [r[0] for r in df.select(C.surrogate_key("s", "n")).collect()]
    want = ["a-1", f"{S.KEY_NULL_SENTINEL}-2", "-2"]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in want]


@pytest.mark.parametrize(
    ("day", "want"),
    [
        ("2021-01-01", (2021, 53, "January", False, False)),
        ("2021-09-04", (2021, 35, "September", True, True)),
        ("2024-12-30", (2024, 1, "December", True, False)),
    ],
)
def test_calendar(spark, day, want):
    df = spark.sql(f"SELECT DATE'{day}' AS d")
    parts = C.calendar_columns("d")
    assert tuple(df.select(*[c.alias(n) for n, c in parts.items()]).first()) == want


def test_ticker_and_path(spark):
    df = spark.createDataFrame([(" ibm ", "bronze/source/IBM/weekly.json")], "s string, p string")
    assert tuple(df.select(C.normalise_ticker("s"), C.symbol_from_path("p")).first()) == ("IBM", "IBM")


def test_sector_groups(spark):
    items = ["Technology", "Financials", "Financial Services", "Utilities", None]
    got = values(spark, C.first_by_rule("v", S.SECTOR_GROUPS, S.DEFAULT_SECTOR_GROUP), items)
    assert got == ["Tech & Comm", "Financial Services", *["Consumer & Others"], "Resources & Infrastructure", "Consumer & Others"]


def test_is_finite_passes_null_on(spark):
    assert values(spark, C.is_finite("v"), [1.0, float("nan"), float("-inf"), None], "double") == [True, False, False, None]
