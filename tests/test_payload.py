import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas as S
from candlewick.operators import (
    classify,
    failure_counts,
    flatten,
    parse,
    screen,
    split_outcomes,
    standardise,
    tolerant_casts,
    typed_rows,
    universe,
    validate,
)
from candlewick.operators.payload import dated
from candlewick.operators.universe import request_fields

from helpers import GOOD, NEGATIVE, SERIES, frame, payload, without

NOW = "2025-12-01 09:30:00"

CASES = {
    "good": payload({"2019-03-15": GOOD}),
    "no_series": "{}",
    "empty": payload({}),
    "null_series": json.dumps({SERIES: None}),
    "error": json.dumps({"Error Message": "bad symbol"}),
    "error_null": json.dumps({"Error Message": None}),
    "limit": json.dumps({"Note": "... API call frequency ..."}),
    "info": json.dumps({"Information": "x"}),
    "note_data": payload({"2019-03-15": GOOD}, Note="hello"),
    "bad_date": payload({"2019-03-15": GOOD, "2023-13-40": GOOD}),
    "no_volume": payload({"2019-03-15": without("6. volume")}),
    "ragged": payload({"2019-03-08": without("6. volume"), "2019-03-15": GOOD}),
    "text_close": payload({"2019-03-15": {**GOOD, "4. close": "abc"}}),
    "bad_extra": payload({"2019-03-15": {**GOOD, "7. dividend amount": "none"}}),
    "bad_text": "{bad",
    "cut_off": payload({"2019-03-15": GOOD})[:-1],
    "trailing": "{} rest",
    "two_docs": payload({"2019-03-15": GOOD}) + payload({"2019-03-22": GOOD}),
    "text_series": json.dumps({SERIES: "none"}),
    "text_entry": payload({"2019-03-15": GOOD, "2019-03-22": "oops"}),
    "null_entry": payload({"2019-03-15": GOOD, "2019-03-22": None}),
    "list": "[1]",
    "error_and_data": payload({"2019-03-15": GOOD}, **{"Error Message": "late"}),
    "huge": payload({"2019-03-15": {**GOOD, "2. high": "1e11"}}),
    "huge_dropped": payload({"2019-03-15": {**GOOD, "2. high": "1e11", "4. close": "-1"}}),
    "no_dividend": payload({"2019-03-15": without("7. dividend amount")}),
    "long_symbol_x": payload({"2019-03-15": GOOD}),
}


@pytest.fixture(scope="module")
def cases(spark):
    return frame(spark, *CASES.items()).cache()


def by_symbol(df, *columns):
    return {r["symbol"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_outcomes(cases):
    got = by_symbol(classify(cases), "success", "error_type", "record_count")
    ok = {"good": 1, "empty": 0, "note_data": 1, "bad_date": 2, "ragged": 2, "huge": 1}
    for name, n in ok.items():
        assert got[name] == (True, None, n), name
    assert got["error"] == got["error_null"] == got["error_and_data"] == (False, "API_INVALID_CALL", None)
    for name in ("limit", "info", "no_series", "list"):
        assert got[name] == (False, "APIValueError", None), name
    for name in ("null_series", "text_series", "text_entry", "null_entry"):
        assert got[name] == (False, "AttributeError", None), name
    for name in ("bad_text", "cut_off", "trailing", "two_docs"):
        assert got[name] == (False, "JSONDecodeError", None), name


def test_outcome_texts(cases):
    got = by_symbol(classify(cases), "error_msg", "raw_json")
    assert got["error"] == ("API business error: bad symbol", None)
    assert got["error_null"][0] == "API business error: None"
    assert got["limit"][0] == "Alpha Vantage Rate Limit Exceeded (5 calls/min or 500/day)."
    assert got["info"][0] == "API response for info is malformed or empty."
    assert got["good"] == (None, CASES["good"])


def test_transport_error_comes_first(spark):
    df = spark.createDataFrame([("A", None, "timed out"), ("B", "{}", None)], "symbol string, payload string, e string")
    got = by_symbol(classify(df, transport_error="e"), "error_type", "error_msg")
    assert got["A"] == ("RequestException", "Network/MTU Error: timed out")
    assert got["B"][0] == "APIValueError"


def test_split(spark, cases):
    classified = classify(cases)
    ok, failed = split_outcomes(classified)
    assert ok.count() + failed.count() == len(CASES)
    counts = {r["error_type"]: r["n_failed"] for r in failure_counts(classified).collect()}
    assert counts == {"API_INVALID_CALL": 3, "APIValueError": 4, "AttributeError": 4, "JSONDecodeError": 4}
    with pytest.raises(ValueError):
        split_outcomes(classify(frame(spark, ("A", "{}"))))
    unknown = classified.withColumn("success", F.lit(None).cast("boolean"))
    assert [df.count() for df in split_outcomes(unknown, require_success=False)] == [0, 0]


def test_validation(cases):
    got = by_symbol(validate(cases), "is_valid", "failed_check", "detail")
    for name in ("good", "note_data", "ragged", "huge", "no_dividend"):
        assert got[name] == (True, None, None), name
    want = {
        "no_series": "missing_series",
        "empty": "empty_series",
        "null_series": "malformed_series",
        "null_entry": "malformed_series",
        "two_docs": "unreadable",
        "error": "error_marker",
        "error_and_data": "error_marker",
        "limit": "missing_series",
        "bad_date": "invalid_date",
        "no_volume": "missing_field",
        "text_close": "not_numeric",
        "bad_extra": "not_numeric",
        "bad_text": "unreadable",
        "list": "unreadable",
    }
    assert {name: got[name][1] for name in want} == want
    assert got["no_volume"][2] == "6. volume"


def test_validation_can_raise(spark):
    with pytest.raises(ValueError, match="missing_series"):
        validate(frame(spark, ("A", "{}")), raise_on_fail=True)


def test_screen(cases):
    got = {s: r for s, (r,) in by_symbol(screen(cases), "reject_reason").items()}
    want = {
        "bad_text": "unreadable",
        "two_docs": "unreadable",
        "text_entry": "malformed_series",
        "null_entry": "malformed_series",
        "bad_date": "invalid_date",
        "no_volume": "missing_field",
        "huge": "overflow",
        "long_symbol_x": "symbol",
    }
    assert {name: got[name] for name in want} == want
    # A row that the quality rule drops never reaches the stored type.
    for name in ("good", "empty", "no_series", "text_close", "ragged", "huge_dropped"):
        assert got[name] is None or len(name) > S.MAX_SYMBOL_LENGTH, name


def test_last_of_repeated_keys_counts(spark):
    row = lambda o, c: json.dumps({**GOOD, "1. open": o, "4. close": c})
    twice = f'{{"{SERIES}": {{"2019-03-15": {row("1", "5")}, "2019-03-15": {row("7", "9")}}}}}'
    fields = f'{{"{SERIES}": {{"2019-03-15": {{"1. open": "3", {json.dumps(GOOD)[1:]}}}}}'
    df = frame(spark, ("twice", twice), ("fields", fields))
    assert by_symbol(classify(df), "record_count") == {"twice": (1,), "fields": (1,)}
    got = by_symbol(standardise(typed_rows(screen(df)), NOW), "open", "close")
    assert {k: tuple(map(float, v)) for k, v in got.items()} == {"twice": (7, 9), "fields": (40.25, 46.125)}


def test_a_line_break_ends_no_number(spark):
    df = frame(spark, ("A", payload({"2019-03-15": {**GOOD, "6. volume": "1\n"}})))
    assert standardise(typed_rows(screen(df)), NOW).count() == 0


def test_rows_below_zero_are_dropped_each_for_itself(spark):
    days = {f"2018-06-{d:02d}": {**GOOD, "4. close": str(3 - d), "6. volume": str(9 - d)} for d in range(1, 13)}
    raw = flatten(parse(frame(spark, ("QQX", payload(days)))))
    kept = standardise(tolerant_casts(raw), NOW)
    assert sorted(str(r["price_date"]) for r in kept.collect()) == ["2018-06-01", "2018-06-02", "2018-06-03"]
    assert kept.columns == S.SILVER_SCHEMA.names


def test_stored_types(spark):
    typed = tolerant_casts(flatten(parse(frame(spark, ("N", payload({"2001-02-03": {f: "1" for f in GOOD}}))))))
    doubles = {f.name for f in typed.schema if isinstance(f.dataType, T.DoubleType)}
    assert doubles == set(S.PRICE_COLUMNS) and dict(typed.dtypes)["volume"] == "bigint"
    stored = standardise(typed, NOW)
    assert [f.dataType for f in stored.schema] == [f.dataType for f in S.SILVER_SCHEMA]


ROWS = {
    "keep": GOOD,
    "fraction": {**GOOD, "6. volume": "1000.5"},
    "neg_open": {**GOOD, "1. open": "-1", "2. high": "x"},
    "nan_open": {**GOOD, "1. open": "NaN"},
    "inf_close": {**GOOD, "4. close": "inf"},
    "nan_high": {**GOOD, "2. high": "NaN", "3. low": "-inf"},
    "neg_vol": {**GOOD, "6. volume": "-1"},
    "null_adj": {**GOOD, "5. adjusted close": None},
}


@pytest.mark.parametrize("path", ["text", "typed"])
def test_quality_rule(spark, path):
    df = frame(spark, *[(name, payload({"2019-03-15": row})) for name, row in ROWS.items()])
    typed = tolerant_casts(flatten(parse(df))) if path == "text" else typed_rows(screen(df))
    got = by_symbol(standardise(typed, NOW), "open", "high", "low", "adjusted_close")
    assert set(got) == {"keep", "neg_open", "nan_high", "null_adj"}
    assert float(got["neg_open"][0]) == -1 and got["neg_open"][1] is None
    assert got["nan_high"][1:3] == (None, None)
    assert got["null_adj"][3] is None


def test_flatten_without_series_is_empty(spark):
    df = frame(spark, ("A", "{}"), ("B", payload({})), ("C", "{bad"))
    assert flatten(parse(df)).count() == 0


def test_lineage_columns(spark):
    row = standardise(typed_rows(screen(frame(spark, ("A", CASES["good"])))), NOW).first()
    assert (str(row["_processing_date"]), row["_data_source"]) == ("2025-12-01", "alpha_vantage")
    assert row["_ingestion_timestamp"].isoformat().startswith("2025-12-01T09:30")


def test_universe(spark):
    assert [r[0] for r in universe(spark).collect()] == ["IBM", "MSFT"]
    row = request_fields(universe(spark, '["V"]'), "u", "WEEKLY", "k").first()
    assert row["api_params"] == {"function": "WEEKLY", "apikey": "k", "symbol": "V"}


@pytest.mark.parametrize("step", [flatten, dated])
def test_entries_parse_a_payload_once(spark, step):
    plan = step(parse(frame(spark, *CASES.items())))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_entries_of_a_series(spark):
    rows = dated(parse(frame(spark, *CASES.items())), ["symbol"]).groupBy("symbol").count()
    got = {r["symbol"]: r["count"] for r in rows.collect()}
    assert got["good"] == 1 and got["bad_date"] == 2 and got["null_entry"] == 2
    assert not {"empty", "null_series", "no_series", "bad_text", "text_series"} & set(got)
