"""Row-per-payload work: parse, classify, validate, screen.

Every rule is an expression over the parsed map of its own row, so none of this shuffles and a
payload is judged where it was read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.functions import is_finite, is_number, strict_date, tolerant_bigint, tolerant_double

from .ranking import rows_where

READABLE = "_readable"
KEYS = "_keys"
DOC = "_doc"
SERIES = "_series"
ROWS = "_rows"
PARSED = [READABLE, KEYS, DOC, SERIES]

_OVERFLOW = 10.0 ** (S.PRICE.precision - S.PRICE.scale)


def _last_wins(m: Column) -> Column:
    """A map in which each key has the last of its values, as JSON readers have it.

    Only a map with repeated keys is rebuilt.
    """
    keys = F.map_keys(m)
    once = F.array_distinct(keys)
    last = F.transform(once, lambda k: F.element_at(F.filter(F.map_entries(m), lambda e: e["key"] == k), -1)["value"])
    return F.when(F.size(keys) > F.size(once), F.map_from_arrays(once, last)).otherwise(m)


def _repeats(m: Column) -> Column:
    return F.size(F.map_keys(m)) > F.size(F.array_distinct(F.map_keys(m)))


def parse(df: DataFrame, payload: str = "payload", series_key: str = S.SERIES_KEY) -> DataFrame:
    """Add whether the text is one JSON document, its key names, the parsed document and its series map.

    ``_keys`` is null when the text is not one JSON object; ``{}`` gives an empty list.  Of repeated dates and
    fields the last one counts.  A series that is no map of maps is null.  A frame that is parsed already comes back
    as it is, so steps in a row share one parse.
    """
    if KEYS in df.columns:
        return df
    text = F.col(payload)
    # The other JSON readers stop at the end of the first document.  So does this one, where a tail begins with a bracket;
    # such a tail makes no object either.
    listed = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    nested = F.json_object_keys(F.concat(F.lit('{"x":'), text, F.lit("}"))) == F.array(F.lit("x"))
    single = F.coalesce(listed & (~text.contains("]") | nested), F.lit(False))
    by_date = F.col(SERIES)
    return (
        df.withColumn(READABLE, single)
        .withColumn(KEYS, F.when(F.col(READABLE), F.json_object_keys(text)))
        .withColumn(DOC, F.from_json(F.when(F.col(READABLE), text), S.payload_schema(series_key)))
        .withColumn(SERIES, _last_wins(F.col(DOC)[series_key]))
        .withColumn(
            SERIES,
            F.when(
                F.exists(F.map_values(by_date), _repeats), F.transform_values(by_date, lambda _, row: _last_wins(row))
            ).otherwise(by_date),
        )
    )


def dated(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, ``day`` and ``row`` of each entry of the parsed series; a payload without entries has none.

    For a plain explode of a column the optimizer adds a filter on its size, pushes that down to the scan and copies the
    parsing into it, dozens of times a payload.  An outer one has no such filter; its empty rows go here.
    """
    rows = parsed.select(*keep, F.explode_outer(SERIES).alias("day", "row"))
    return rows.filter(F.col("day").isNotNull())


def _has(key: str) -> Column:
    """Key presence; a key whose value is JSON null is present."""
    return F.coalesce(F.array_contains(KEYS, key), F.lit(False))


def _malformed(series_key: str) -> Column:
    """The series is there, but it is no map, or one of its entries is none."""
    no_entry = F.exists(F.map_values(SERIES), lambda row: row.isNull())
    return _has(series_key) & (F.col(SERIES).isNull() | F.coalesce(no_entry, F.lit(False)))


def _marker(key: str) -> Column:
    return F.col(DOC)[key]


def classify(
    df: DataFrame,
    payload: str = "payload",
    series_key: str = S.SERIES_KEY,
    transport_error: str | None = None,
    keep_parsed: bool = False,
) -> DataFrame:
    """Extraction envelope of each payload: success flag, error text and type, record count.

    The first rule that holds decides: transport failure (when such a column is named), unreadable
    JSON, rate limit, business error, series missing, series malformed.
    """
    limited = F.coalesce(_marker(S.NOTE_KEY).contains(S.RATE_LIMIT_PHRASE), F.lit(False))
    business = F.concat(
        F.lit("API business error: "), F.coalesce(_marker(S.ERROR_KEY), F.lit("None"))
    )
    malformed = F.concat(
        F.lit("API response for "), F.col("symbol"), F.lit(" is malformed or empty.")
    )
    no_map = F.concat(F.lit("series of "), F.col("symbol"), F.lit(" is no map of rows"))
    rules = [
        # Other JSON values (a list, a number) are readable; they have no series.
        (~F.col(READABLE), "JSONDecodeError", F.lit("Invalid JSON response from API")),
        (limited, "APIValueError", F.lit(S.RATE_LIMIT_TEXT)),
        (_has(S.ERROR_KEY), "API_INVALID_CALL", business),
        (~_has(series_key), "APIValueError", malformed),
        (_malformed(series_key), "AttributeError", no_map),
    ]
    if transport_error is not None:
        failed = F.col(transport_error)
        text = F.concat(F.lit("Network/MTU Error: "), failed)
        rules.insert(0, (failed.isNotNull(), "RequestException", text))

    def chain(values: Sequence[Column]) -> Column:
        first, *rest = zip([cond for cond, _, _ in rules], values, strict=True)
        return reduce(lambda acc, rule: acc.when(*rule), rest, F.when(*first))

    parsed = parse(df, payload, series_key).withColumn(
        "error_type", chain([F.lit(kind) for _, kind, _ in rules])
    )
    success = F.col("error_type").isNull()
    return (
        parsed.withColumn("error_msg", chain([text for _, _, text in rules]))
        .withColumn("success", success)
        .withColumn("raw_json", F.when(success, F.col(payload)))
        .withColumn("record_count", F.when(success, _size().cast("bigint")))
        .drop(*([] if keep_parsed else PARSED))
    )


def split_outcomes(classified: DataFrame, require_success: bool = True) -> tuple[DataFrame, DataFrame]:
    """Successful and failed envelopes; a flag that is null is in neither."""
    ok, failed = rows_where(classified, "success"), rows_where(classified, ~F.col("success"))
    if require_success and ok.isEmpty():
        raise ValueError("no extraction was successful")
    return ok, failed


def failure_counts(classified: DataFrame) -> DataFrame:
    """Failures per error type; the failed names stay a frame and are never gathered."""
    failed = rows_where(classified, ~F.col("success"))
    return failed.groupBy("error_type").agg(F.count(F.lit(1)).alias("n_failed"))


def _fields() -> Column:
    return F.map_values(SERIES)


def _size() -> Column:
    return F.coalesce(F.greatest(F.size(SERIES), F.lit(0)), F.lit(0))


def _bad_dates() -> Column:
    return F.size(F.filter(F.map_keys(SERIES), lambda day: strict_date(day).isNull()))


def _has_bad_date() -> Column:
    return F.exists(F.map_keys(SERIES), lambda day: strict_date(day).isNull())


def _lacks(field: str) -> Column:
    """True when no row of the series has the field."""
    return ~F.exists(_fields(), lambda row: F.coalesce(F.map_contains_key(row, field), F.lit(False)))


def _is_bad(name: Column, text: Column) -> Column:
    return name.rlike(S.NUMBERED_FIELD) & text.isNotNull() & ~is_number(text)


def _has_bad_number() -> Column:
    return F.exists(
        _fields(), lambda row: F.exists(F.map_entries(row), lambda e: _is_bad(e["key"], e["value"]))
    )


def _bad_numbers() -> Column:
    bad = F.transform(_fields(), lambda row: F.size(F.map_filter(row, _is_bad)))
    return F.aggregate(bad, F.lit(0), lambda total, n: total + F.greatest(n, F.lit(0)))


def validate(
    df: DataFrame,
    payload: str = "payload",
    series_key: str = S.SERIES_KEY,
    required: Sequence[str] = tuple(S.REQUIRED_FIELDS),
    raise_on_fail: bool = False,
) -> DataFrame:
    """Add ``is_valid``, ``failed_check`` and ``detail``; the first failing check wins."""
    missing = F.filter(F.array(*[F.when(_lacks(f), F.lit(f)) for f in required]), lambda f: f.isNotNull())
    checks = [
        (F.col(KEYS).isNull(), "unreadable", F.lit("not a JSON object")),
        (_has(S.ERROR_KEY), "error_marker", F.coalesce(_marker(S.ERROR_KEY), F.lit("None"))),
        (~_has(series_key), "missing_series", F.lit(series_key)),
        (_malformed(series_key), "malformed_series", F.lit(series_key)),
        (_size() == 0, "empty_series", F.lit("no rows")),
        (_has_bad_date(), "invalid_date", _bad_dates().cast("string")),
        (F.size(missing) > 0, "missing_field", F.element_at(missing, 1)),
        (_has_bad_number(), "not_numeric", _bad_numbers().cast("string")),
    ]
    name, detail = F.when(checks[0][0], checks[0][1]), None
    for cond, label, _ in checks[1:]:
        name = name.when(cond, label)
    for _, label, text in checks:
        hit = F.col("failed_check") == label
        detail = F.when(hit, text) if detail is None else detail.when(hit, text)
    judged = (
        parse(df, payload, series_key)
        .withColumn("failed_check", name)
        .withColumn("detail", detail)
        .withColumn("is_valid", F.col("failed_check").isNull())
        .drop(*PARSED)
    )
    if raise_on_fail:
        worst = rows_where(judged, ~F.col("is_valid")).select("symbol", "failed_check", "detail").first()
        if worst is not None:
            raise ValueError(f"payload of {worst['symbol']}: {worst['failed_check']} ({worst['detail']})")
    return judged


def _typed(entry: Column) -> Column:
    """One dated entry of the series with its values cast leniently, and whether it is to be stored."""
    row = entry["value"]
    cells = {name: tolerant_double(row[field]) for field, name in S.SERIES_FIELDS.items()}
    cells["volume"] = tolerant_bigint(row["6. volume"])
    return F.struct(
        strict_date(entry["key"]).alias("price_date"), *[c.alias(name) for name, c in cells.items()]
    )


def _overflows(row: Column) -> Column:
    over = [is_finite(row[name]) & (F.abs(row[name]) >= _OVERFLOW) for name in S.PRICE_COLUMNS]
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in over])


def quality_rule(opened: Column, close: Column, volume: Column) -> Column:
    """Open and close are ordinary numbers, close and volume are not negative; null fails."""
    rule = is_finite(opened) & is_finite(close) & (close >= 0) & (volume >= 0)
    return F.coalesce(rule, F.lit(False))


def screen(df: DataFrame, payload: str = "payload", series_key: str = S.SERIES_KEY) -> DataFrame:
    """Parse and add the typed rows, and ``reject_reason``: what makes a load fail as a whole.

    A load is all or nothing per payload, so one unusable date, an entry that is no row, a missing field, a price beyond the
    stored type or an over-long symbol rejects it.  Other payloads go on.
    """
    fields = F.array(*[F.when(_lacks(f), F.lit(f)) for f in S.SERIES_FIELDS])
    lacks = F.exists(fields, lambda f: f.isNotNull())
    bad_date = F.exists(ROWS, lambda row: row["price_date"].isNull())
    overflow = F.exists(
        ROWS, lambda row: quality_rule(row["open"], row["close"], row["volume"]) & _overflows(row)
    )
    reason = (
        F.when(F.col(KEYS).isNull(), "unreadable")
        .when(F.col("symbol").isNull() | (F.length("symbol") > S.MAX_SYMBOL_LENGTH), "symbol")
        .when(_malformed(series_key), "malformed_series")
        .when(_size() == 0, F.lit(None))
        .when(lacks, "missing_field")
        .when(bad_date, "invalid_date")
        .when(overflow, "overflow")
    )
    return (
        parse(df, payload, series_key)
        .withColumn(ROWS, F.transform(F.map_entries(SERIES), _typed))
        .withColumn("reject_reason", reason)
    )


def pack_series(
    prices: DataFrame, keys: Sequence[str], fields: dict[str, Column], series_key: str = S.SERIES_KEY
) -> DataFrame:
    """Price rows back to payload text, one document per key group.

    The group is gathered into one document, so ``keys`` must bound it (symbol and year give at most
    53 weeks).
    """
    row = F.create_map(*[part for name, c in fields.items() for part in (F.lit(name), c.cast("string"))])
    entry = F.struct(F.date_format("price_date", "yyyy-MM-dd").alias("day"), row.alias("row"))
    series = F.map_from_entries(F.collect_list(entry))
    return prices.groupBy(*keys).agg(
        F.to_json(F.struct(series.alias(series_key)), {"ignoreNullFields": "false"}).alias("payload")
    )
