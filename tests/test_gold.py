import datetime as dt
from decimal import Decimal

import pytest

from candlewick import schemas as S
from candlewick.operators import Check, ContractViolation, between, has_type, matches, not_null, raise_on_error, relationship, run_checks, unique, unique_combination
from candlewick.plans import (
    build_dim_source,
    build_fact,
    build_gold,
    build_staging,
    check_gold,
    gold_mart,
    kpis,
    newest_first,
    price_trend,
    select_rows,
    volume_share,
)
from candlewick.sources import default_seed

WEEK = dt.date(2021, 1, 1)


def silver(spark, *rows):
    """(symbol, date, open, high, low, adjusted_close, volume)"""
    stamp = dt.datetime(2021, 1, 4)
    data = [
        (
            day,
            symbol,
            *[None if x is None else Decimal(str(x)) for x in (opened, high, low, adjusted, adjusted)],
            volume,
            stamp,
            "alpha_vantage",
            stamp.date(),
        )
        for symbol, day, opened, high, low, adjusted, volume in rows
    ]
    return spark.createDataFrame(data, S.SILVER_SCHEMA)


@pytest.fixture(scope="module")
def gold(spark):
    rows = [
        (" ibm ", WEEK, 80, 84, 75, 81, 600),
        ("V", WEEK, 0, 33, 0, 30, 10),
        ("NEW", WEEK, 1, 2, 1, 1, 5),
        ("V", dt.date(2021, 9, 4), 1, 2, 1, 3, 7),
        ("MSFT", WEEK, 1, 2, 1, None, 9),
    ]
    return build_gold(silver(spark, *rows), default_seed(spark))


def test_staging(gold):
    got = {(r["stock_symbol"], r["trade_date"]) for r in gold.staging.collect()}
    assert ("IBM", WEEK) in got and not any(s == "MSFT" for s, _ in got) and len(got) == 4
    assert "_data_source" not in gold.staging.columns


def test_stock_dimension(gold):
    got = {r["symbol"]: r for r in gold.dim_stock.collect()}
    assert set(got) == {"IBM", "V", "NEW"}
    assert got["IBM"]["sector_group"] == "Tech & Comm" and got["IBM"]["has_metadata"]
    assert got["V"]["sector_group"] == "Consumer & Others"
    new = got["NEW"]
    assert (new["company_name"], new["sector"], new["industry"]) == ("Unknown Company", "Unknown Sector", "Unknown Industry")
    assert (new["sector_group"], new["has_metadata"], new["is_active"]) == ("Consumer & Others", False, True)


def test_date_dimension(gold):
    got = {r["week_ending"]: r for r in gold.dim_date.collect()}
    assert (got[WEEK]["year"], got[WEEK]["week_number"], got[WEEK]["is_weekend"]) == (2021, 53, False)
    assert got[dt.date(2021, 9, 4)]["is_weekend"] and got[dt.date(2021, 9, 4)]["is_quarter_reporting_month"]


def test_source_dimension(spark):
    row = build_dim_source(spark).first()
    assert row["source_name"] == "alpha_vantage" and len(row["source_id"]) == 32


def test_source_key_of_the_fact(spark, gold):
    def fact(sources, name="alpha_vantage"):
        return build_fact(gold.staging, gold.dim_stock, gold.dim_date, sources, name)

    one = build_dim_source(spark)
    assert fact(one).select("source_id").distinct().collect() == one.select("source_id").collect()
    assert fact(one, "manual_upload").count() == 0
    second = build_dim_source(spark, {**S.SOURCE_ROW, "api_version": "v2"})
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        fact(one.unionByName(second)).collect()


def test_fact_measures(gold):
    ids = {r["symbol"]: r["stock_id"] for r in gold.dim_stock.collect()}
    days = {r["week_ending"]: r["date_id"] for r in gold.dim_date.collect()}
    got = {(r["stock_id"], r["date_id"]): r for r in gold.fact.collect()}
    ibm = got[ids["IBM"], days[WEEK]]
    assert [str(ibm[c]) for c in ("weekly_return_abs", "weekly_return_pct", "trading_range_abs", "volatility_pct")] == [
        "1.0000", "0.0125", "9.0000", "0.1200",
    ]
    v = got[ids["V"], days[WEEK]]
    assert v["weekly_return_pct"] is None and v["volatility_pct"] is None


def test_contracts_report_what_is_wrong(gold):
    fired = {
        (r["table_name"], r["column_name"], r["check_name"]): r["n_violations"]
        for r in check_gold(gold).filter("n_violations > 0").collect()
    }
    assert fired == {("fact_adjusted_prices", "volatility_pct", "not_null"): 1}
    with pytest.raises(ContractViolation, match="volatility_pct"):
        check_gold(gold, raise_errors=True)


def test_merged_symbols_break_the_grain(spark):
    rows = [("ibm", WEEK, 1, 2, 1, 1, 1), ("IBM", WEEK, 1, 2, 1, 1, 1), ("A#", WEEK, 1, 2, 1, 1, 1)]
    report = check_gold(build_gold(silver(spark, *rows), default_seed(spark)))
    fired = {(r["column_name"], r["check_name"], r["severity"]) for r in report.filter("n_violations > 0").collect()}
    assert fired == {
        ("stock_id,date_id", "unique_combination", "error"),
        ("symbol", "matches", "warn"),
        ("stock_symbol", "matches", "warn"),
    }


def test_null_rules_of_checks(spark):
    df = spark.createDataFrame([("a", None), (None, 1), (None, 1), ("b", 3)], "s string, n int")
    parent = spark.createDataFrame([("a",)], "k string")
    checks = [
        *not_null("t", "s"),
        unique("t", "s"),
        unique_combination("t", "s", "n"),
        relationship("t", "s", "p", "k"),
        between("t", "n", 0, 2),
        between("t", "n", 2, row_condition="s IS NOT NULL"),
        matches("t", "s", "^a$").warn(),
        has_type("t", "n", "INT"),
        has_type("t", "n", "BIGINT"),
        Check("t", ("s",), "accepted_values", options={"values": ["a"]}),
    ]
    report = run_checks({"t": df, "p": parent}, checks)
    got = sorted((r["check_name"], r["n_violations"]) for r in report.collect())
    assert got == [
        ("accepted_values", 1),
        ("between", 0),
        ("between", 1),
        ("has_type", 0),
        ("has_type", 3),
        ("matches", 1),
        ("not_null", 2),
        ("relationship", 1),
        ("unique", 0),
        ("unique_combination", 1),
    ]
    warned = raise_on_error(report.filter("severity = 'warn'"))
    assert [r["check_name"] for r in warned] == ["matches"]


def test_mart(gold):
    mart = gold_mart(gold, ordered=True)
    assert mart.columns == [
        "date", "symbol", "company_name", "sector_group", "adjusted_close_price", "weekly_return_pct",
        "volatility_pct", "trade_volume",
    ]
    assert [(str(r["date"]), r["symbol"]) for r in mart.collect()] == [
        ("2021-01-01", "IBM"), ("2021-01-01", "NEW"), ("2021-01-01", "V"), ("2021-09-04", "V"),
    ]
    assert str(newest_first(mart).first()["date"]) == "2021-09-04"
    assert [r["symbol"] for r in price_trend(mart).collect()] == ["IBM", "NEW", "V", "V"]
    share = {r["sector_group"]: r["volume_share"] for r in volume_share(mart).collect()}
    assert share["Tech & Comm"] == pytest.approx(600 / 622)


def test_indicators_of_an_empty_selection(gold):
    row = kpis(select_rows(gold_mart(gold), [], None)).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0, 0)


def test_indicators(gold):
    row = kpis(select_rows(gold_mart(gold), None, ["IBM", "V"])).first()
    assert (row["tickers"], row["anomalies"]) == (2, 0)
    assert row["avg_volatility_pct"] == pytest.approx((0.12 + 1.0) / 2 * 100)
    assert row["total_volume_millions"] == pytest.approx(617 / 1e6)


def test_build_staging_keeps_other_columns(spark):
    staged = build_staging(silver(spark, ("A", WEEK, 1, 2, 1, 1, 1)))
    assert staged.columns[-1] == "dbt_load_timestamp"
