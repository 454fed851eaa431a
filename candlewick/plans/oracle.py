"""The same questions in plain SQL over the same tables, for an engine that is not Spark."""

from __future__ import annotations

from . import registry as R
from . import views as V
from .contracts import CALENDAR_CONTRACTS, CONTRACTS, FACT, SILVER, SILVER_CONTRACTS, STAGING

_CODE = "CASE p_type " + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in V.TYPE_CODES.items()) + " ELSE lower(p_type) END"
_SYMBOL = f"lower(replace(p_brand, 'Brand#', 'b') || '.' || {_CODE})"

_LINES = f"""lines AS (
  SELECT l.*, {_SYMBOL} AS symbol, CAST(l_extendedprice AS DECIMAL(15,4)) AS price
  FROM lineitem l JOIN part ON p_partkey = l_partkey)"""


def _prices(name: str = "prices", where: str = "TRUE", extra: str = "") -> str:
    more = f", {extra}" if extra else ""
    return f"""{name} AS (
  SELECT CAST(date_trunc('week', day) AS DATE) + 4 AS price_date, symbol{more}, arg_min(low, day) AS open,
    max(high) AS high, min(low) AS low, arg_max(high, day) AS "close", arg_max(net, day) AS adjusted_close,
    CAST(sum(quantity) AS BIGINT) AS volume
  FROM (SELECT symbol{more}, CAST(l_shipdate AS DATE) AS day, min(price) AS low, max(price) AS high,
      CAST(max(price * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(15,4)) AS net,
      sum(CAST(l_quantity AS BIGINT)) AS quantity
    FROM lines WHERE {where} GROUP BY ALL)
  GROUP BY ALL)"""


_SILVER_OUT = """CAST(price_date AS VARCHAR) AS price_date, symbol, CAST(open AS DOUBLE) AS open,
  CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST("close" AS DOUBLE) AS "close",
  CAST(adjusted_close AS DOUBLE) AS adjusted_close, volume, 'alpha_vantage' AS _data_source,
  '2002-01-01' AS _processing_date"""

_GROUP_CASE = (
    "CASE "
    + " ".join(
        f"WHEN m.sector IN ({', '.join(repr(x) for x in members)}) THEN '{label}'"
        for label, members in V.TYPE_GROUPS.items()
    )
    + " ELSE 'Consumer & Others' END"
)


def _key(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


def _calendar(day: str) -> str:
    return f"""CAST(year({day}) AS BIGINT) AS year, CAST(weekofyear({day}) AS BIGINT) AS week_number,
  monthname({day}) AS month_name, month({day}) IN (3, 6, 9, 12) AS is_quarter_reporting_month,
  dayofweek({day}) IN (0, 6) AS is_weekend"""


def _change(value: str, base: str) -> str:
    """Exact ``round(value / base - 1, 4)`` half away from zero, on integers."""
    a, b = (f"CAST({x} * 10000 AS HUGEINT)" for x in (value, base))
    return f"""CASE WHEN {base} = 0 THEN NULL ELSE CAST(sign({a} - {b}) AS HUGEINT)
    * ((20000 * abs({a} - {b}) + {b}) // (2 * {b})) / 10000.0 END"""


_STG = """stg AS (
  SELECT trim(upper(symbol)) AS stock_symbol, price_date AS trade_date, open AS open_price, high AS high_price,
    low AS low_price, "close" AS close_price, adjusted_close AS adjusted_close_price, volume AS trade_volume
  FROM prices WHERE adjusted_close IS NOT NULL)"""

_DIM_STOCK = f"""seed AS (
  SELECT upper({_SYMBOL}) AS symbol, p_name AS company_name, p_type AS sector,
    'size ' || CAST(p_size AS VARCHAR) AS industry
  FROM part WHERE p_type <> 'ECONOMY'),
metadata AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY company_name, sector, industry) AS rn
    FROM seed) WHERE rn = 1),
dim_stock AS (
  SELECT {_key('s.symbol')} AS stock_id, s.symbol, coalesce(m.company_name, 'Unknown Company') AS company_name,
    coalesce(m.sector, 'Unknown Sector') AS sector, coalesce(m.industry, 'Unknown Industry') AS industry,
    {_GROUP_CASE} AS sector_group, coalesce(m.company_name <> 'Unknown Company', FALSE) AS has_metadata,
    TRUE AS is_active
  FROM (SELECT DISTINCT stock_symbol AS symbol FROM stg) s LEFT JOIN metadata m ON m.symbol = s.symbol)"""

_SOURCE_ID = _key("'alpha_vantage'", "'v1'")

_FACT = f"""fact AS (
  SELECT {_key('stock_symbol')} AS stock_id, {_key('trade_date')} AS date_id, {_SOURCE_ID} AS source_id,
    CAST(open_price AS DOUBLE) AS open_price, CAST(high_price AS DOUBLE) AS high_price,
    CAST(low_price AS DOUBLE) AS low_price, CAST(adjusted_close_price AS DOUBLE) AS adjusted_close_price,
    trade_volume, CAST(adjusted_close_price - open_price AS DOUBLE) AS weekly_return_abs,
    {_change('adjusted_close_price', 'open_price')} AS weekly_return_pct,
    CAST(high_price - low_price AS DOUBLE) AS trading_range_abs,
    {_change('high_price', 'low_price')} AS volatility_pct, 'alpha_vantage' AS source_model
  FROM stg)"""

_MART = f"""mart AS (
  SELECT trade_date AS date, s.symbol, s.company_name, s.sector_group,
    CAST(adjusted_close_price AS DOUBLE) AS adjusted_close_price,
    {_change('adjusted_close_price', 'open_price')} AS weekly_return_pct,
    {_change('high_price', 'low_price')} AS volatility_pct, trade_volume
  FROM stg JOIN dim_stock s ON s.symbol = stock_symbol)"""

_SILVER = f"WITH {_LINES}, {_prices()}"
_GOLD = f"{_SILVER}, {_STG}, {_DIM_STOCK}"
_ON_MART = f"{_GOLD}, {_MART}"
_MART_OUT = """CAST(date AS VARCHAR) AS date, symbol, company_name, sector_group, adjusted_close_price,
  weekly_return_pct, volatility_pct, trade_volume"""


def _scored(source: str, key: str, value: str) -> str:
    return f"""scored AS (
  SELECT *, CASE WHEN sd > 0 THEN ({value} - mean) / sd END AS z FROM (
    SELECT *, avg({value}) OVER (PARTITION BY {key}) AS mean, stddev_samp({value}) OVER (PARTITION BY {key}) AS sd
    FROM {source}))"""


_SCORED = f"{_ON_MART}, {_scored('mart', 'symbol', 'adjusted_close_price')}"


def _kpis(where: str) -> str:
    return f"""{_ON_MART}, chosen AS (SELECT * FROM mart WHERE {where}),
{_scored('chosen', 'symbol', 'adjusted_close_price')}
SELECT count(DISTINCT symbol) AS tickers,
  round(coalesce(avg(volatility_pct), 0) * 100, 6) AS avg_volatility_pct,
  round(coalesce(avg(weekly_return_pct), 0), 6) AS avg_weekly_return,
  round(CAST(coalesce(sum(trade_volume), 0) AS DOUBLE) / 1e6, 6) AS total_volume_millions,
  count(*) FILTER (WHERE abs(z) > 2) AS anomalies FROM scored"""


_SECTOR_LIST = ", ".join(f"'{s}'" for s in R.SECTORS)
_FIRST3 = f"(SELECT DISTINCT symbol FROM mart WHERE sector_group IN ({_SECTOR_LIST}) ORDER BY symbol LIMIT 3)"

# --- payloads: plain JSON functions on the same texts ----------------------------

_BAD_NUMBERS = " + ".join(
    f"CASE WHEN t_{c} IS NOT NULL AND try_cast(t_{c} AS DOUBLE) IS NULL THEN 1 ELSE 0 END"
    for c in ("open", "high", "low", "close", "adjusted", "volume")
)

_PAYLOADS = f"""ev AS (
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
    CAST(CAST(value AS DECIMAL(15,4)) AS VARCHAR) AS v, CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
payloads AS (SELECT event_id, 'U' || user_id AS symbol, {V.EVENT_PAYLOAD_SQL} AS payload FROM ev),
single AS (
  SELECT event_id, symbol, CASE WHEN event_type = 'view' AND k BETWEEN 80 AND 91
    THEN {V._ONE_DAY} ELSE payload END AS payload FROM payloads JOIN ev USING (event_id)),
docs AS (
  SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM single),
parts AS (
  SELECT *, list_contains(json_keys(doc), 'Weekly Adjusted Time Series') AS has_series,
    list_contains(json_keys(doc), 'Error Message') AS has_error, json_extract_string(doc, '$.Note') AS note,
    json_extract_string(doc, '$."Error Message"') AS error,
    json_extract(doc, '$."Weekly Adjusted Time Series"') AS series
  FROM docs),
kinds AS (SELECT *, has_series AND (json_type(series) <> 'OBJECT' OR CAST(series AS VARCHAR) LIKE '%:null%')
    AS malformed, CASE WHEN json_type(series) = 'OBJECT' THEN series END AS days FROM parts),
shaped AS (SELECT *, coalesce(len(json_keys(days)), 0) AS n_days, json_keys(days)[1] AS d FROM kinds),
one_day AS (
  SELECT *, json_extract(series, '$."' || d || '"') AS obs FROM shaped),
cells AS (
  SELECT *, json_keys(obs) AS fields, json_extract_string(obs, '$."1. open"') AS t_open,
    json_extract_string(obs, '$."2. high"') AS t_high, json_extract_string(obs, '$."3. low"') AS t_low,
    json_extract_string(obs, '$."4. close"') AS t_close,
    json_extract_string(obs, '$."5. adjusted close"') AS t_adjusted,
    json_extract_string(obs, '$."6. volume"') AS t_volume
  FROM one_day),
numbers AS (
  SELECT *, {_BAD_NUMBERS} AS n_bad FROM cells),
judged AS (
  SELECT *, CASE WHEN doc IS NULL THEN 'unreadable' WHEN has_error THEN 'error_marker'
      WHEN NOT has_series THEN 'missing_series' WHEN malformed THEN 'malformed_series' WHEN n_days = 0 THEN 'empty_series'
      WHEN NOT regexp_full_match(d, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 'invalid_date'
      WHEN NOT list_has_all(fields, ['1. open', '4. close', '6. volume']) THEN 'missing_field'
      WHEN n_bad > 0 THEN 'not_numeric' END AS failed,
    CASE WHEN doc IS NULL THEN 'unreadable' WHEN malformed THEN 'malformed_series' WHEN n_days = 0 THEN NULL WHEN len(fields) < 6 THEN 'missing_field'
      WHEN NOT regexp_full_match(d, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN 'invalid_date' END AS reject,
    CASE WHEN doc IS NULL THEN 'JSONDecodeError'
      WHEN coalesce(note LIKE '%API call frequency%', FALSE) THEN 'APIValueError'
      WHEN has_error THEN 'API_INVALID_CALL' WHEN NOT has_series THEN 'APIValueError'
      WHEN malformed THEN 'AttributeError' END AS etype
  FROM numbers),
accepted AS (
  SELECT *, n_days > 0 AND coalesce(try_cast(t_open AS DOUBLE) IS NOT NULL AND try_cast(t_close AS DOUBLE) >= 0
    AND try_cast(t_volume AS BIGINT) >= 0, FALSE) AS is_kept
  FROM judged WHERE reject IS NULL)"""
_ON_PAYLOADS = f"WITH {_PAYLOADS}"


# --- checks ------------------------------------------------------------------------


def _row(check, sql: str) -> str:
    return (
        f"SELECT '{check.table}' AS table_name, '{check.column}' AS column_name, '{check.kind}' AS check_name, "
        f"'{check.severity}' AS severity, CAST(({sql}) AS BIGINT) AS n_violations"
    )


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _check_sql(check) -> str:
    t, c, o = check.table, check.columns[0], check.options
    if check.kind == "not_null":
        return _row(check, f"SELECT count(*) FROM {t} WHERE {c} IS NULL")
    if check.kind in ("unique", "unique_combination"):
        where = f"WHERE {c} IS NOT NULL" if check.kind == "unique" else ""
        keys = ", ".join(check.columns)
        return _row(
            check, f"SELECT count(*) FROM (SELECT {keys} FROM {t} {where} GROUP BY {keys} HAVING count(*) > 1)"
        )
    if check.kind == "relationship":
        return _row(
            check,
            f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {o['to']} r WHERE r.{o['field']} = {t}.{c})",
        )
    if check.kind == "accepted_values":
        return _row(check, f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({', '.join(map(_literal, o['values']))})")
    if check.kind == "matches":
        return _row(check, f"SELECT count(*) FROM {t} WHERE NOT regexp_matches({c}, '{o['pattern']}')")
    if check.kind == "between":
        bounds = [f"{c} < {_literal(o['low'])}"] if o["low"] is not None else []
        bounds += [f"{c} > {_literal(o['high'])}"] if o["high"] is not None else []
        return _row(
            check, f"SELECT count(*) FROM {t} WHERE ({o['where'] or 'TRUE'}) AND ({' OR '.join(bounds)})"
        )
    return _row(
        check,
        f"SELECT count({c}) FROM {t} WHERE lower(typeof({c})) <> '{str(o['type']).lower()}'",
    )


def _checks(checks) -> str:
    return " UNION ALL ".join(_check_sql(c) for c in checks)


def _report() -> str:
    """Contract report of the gold build, with the models as CTEs under their table names."""
    models = f"""{STAGING} AS (SELECT *, CAST(adjusted_close_price AS DOUBLE) AS acp FROM stg),
dim_date AS (SELECT {_key('d')} AS date_id, d AS week_ending FROM (SELECT DISTINCT trade_date AS d FROM stg)),
dim_source AS (SELECT {_SOURCE_ID} AS source_id, 'alpha_vantage' AS source_name, 'Gold' AS source_tier,
  'Weekly' AS update_frequency, 'https://www.alphavantage.co/documentation/' AS documentation_url),
{_FACT}, {FACT} AS (SELECT * FROM fact)"""
    return f"{_GOLD}, {models} {_checks(CONTRACTS)}"


_SPLIT = f"""WITH {_LINES}, {_prices('stored', "l_linestatus = 'F'")},
{_prices('batch', "l_linestatus = 'O'", 'l_returnflag')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY price_date, symbol ORDER BY l_returnflag) AS rn FROM batch),
fresh AS (SELECT * EXCLUDE (rn) FROM ranked r WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.price_date = r.price_date AND s.symbol = r.symbol))"""

_CAST_TEXT = """CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS VARCHAR)
  WHEN l_linestatus = 'O' THEN ' ' || CAST(l_linenumber AS VARCHAR)
  WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS VARCHAR) || '.5d'
  ELSE '-' || CAST(l_linenumber AS VARCHAR) END"""

_UNIVERSE = "unnest(CAST('" + R.UNIVERSE_JSON + "' AS JSON)::VARCHAR[])"

ORACLE: dict[str, str] = {
    "stg_prices": f"""{_SILVER}, {_STG}
SELECT stock_symbol, CAST(trade_date AS VARCHAR) AS trade_date, CAST(open_price AS DOUBLE) AS open_price,
  CAST(high_price AS DOUBLE) AS high_price, CAST(low_price AS DOUBLE) AS low_price,
  CAST(close_price AS DOUBLE) AS close_price, CAST(adjusted_close_price AS DOUBLE) AS adjusted_close_price,
  trade_volume, '2002-01-01' AS _processing_date FROM stg""",
    "dim_date": f"""SELECT {_key('d')} AS date_id, CAST(d AS VARCHAR) AS week_ending, {_calendar('d')}
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
    "calendar_quarters": """SELECT CAST(year(o_orderdate) AS BIGINT) AS year,
  CAST(quarter(o_orderdate) AS BIGINT) AS quarter, month(o_orderdate) IN (3, 6, 9, 12) AS is_quarter_reporting_month,
  count(*) AS n_orders, count(*) FILTER (WHERE dayofweek(o_orderdate) IN (0, 6)) AS n_weekend
FROM orders GROUP BY 1, 2, 3""",
    "dim_stock": f"{_GOLD} SELECT * FROM dim_stock",
    "dim_source": f"""{_SILVER}, {_STG}
SELECT {_SOURCE_ID} AS source_id, 'alpha_vantage' AS source_name, 'Weekly Adjusted Prices' AS data_content,
  'Gold' AS source_tier, 'Weekly' AS update_frequency, 'v1' AS api_version,
  'https://www.alphavantage.co/documentation/' AS documentation_url, 'REST API' AS extraction_method,
  count(*) AS n_rows, CAST(sum(trade_volume) AS BIGINT) AS total_volume FROM stg""",
    "fact_prices": f"{_SILVER}, {_STG}, {_FACT} SELECT * FROM fact",
    "gold_mart": f"{_ON_MART} SELECT {_MART_OUT} FROM mart",
    "sector_performance": f"""{_ON_MART}
SELECT sector_group, count(*) AS n_rows, round(avg(weekly_return_pct), 6) AS avg_weekly_return,
  round(avg(volatility_pct), 6) AS avg_volatility, CAST(sum(trade_volume) AS BIGINT) AS total_volume
FROM mart GROUP BY sector_group""",
    "zscore": f"""{_SCORED}
SELECT CAST(date AS VARCHAR) AS date, symbol, adjusted_close_price, round(z, 6) AS z_score FROM scored""",
    "zscore_events": f"""WITH {_scored('events', 'user_id', 'value')}
SELECT event_id, user_id, round(value, 6) AS value, round(z, 6) AS z_score FROM scored""",
    "anomaly_count": f"""{_SCORED}
SELECT symbol, count(*) AS n_rows, count(*) FILTER (WHERE abs(z) > 2) AS anomalies FROM scored GROUP BY symbol""",
    "anomaly_count_lines": f"""WITH {_scored('lineitem', 'l_suppkey', 'l_extendedprice')}
SELECT l_suppkey, count(*) AS n_rows, count(*) FILTER (WHERE abs(z) > 2) AS anomalies
FROM scored GROUP BY l_suppkey""",
    "anomalies": f"""{_SCORED}
SELECT CAST(date AS VARCHAR) AS date, symbol, adjusted_close_price, round(z, 6) AS z_score
FROM scored WHERE abs(z) > 2""",
    "kpis": _kpis("TRUE"),
    "kpis_default_selection": _kpis(f"sector_group IN ({_SECTOR_LIST}) AND symbol IN {_FIRST3}"),
    "kpis_empty_selection": _kpis("FALSE"),
    "volume_share": f"""{_ON_MART}
SELECT sector_group, CAST(sum(trade_volume) AS BIGINT) AS trade_volume,
  round(CAST(sum(trade_volume) AS DOUBLE) / (SELECT sum(trade_volume) FROM mart), 6) AS volume_share
FROM mart GROUP BY sector_group""",
    "volume_share_lines": """SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
  round(sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem), 6) AS quantity_share
FROM lineitem GROUP BY l_suppkey""",
    "volatility_quartiles": f"""{_ON_MART}
SELECT symbol, count(volatility_pct) AS n, min(volatility_pct) AS min,
  round(quantile_cont(volatility_pct, 0.25), 6) AS q25, round(quantile_cont(volatility_pct, 0.5), 6) AS q50,
  round(quantile_cont(volatility_pct, 0.75), 6) AS q75, max(volatility_pct) AS max
FROM mart WHERE volatility_pct IS NOT NULL GROUP BY symbol""",
    "price_quantiles_lines": """SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS min,
  round(quantile_cont(l_extendedprice, 0.1), 6) AS q10, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
  round(quantile_cont(l_extendedprice, 0.9), 6) AS q90, round(quantile_cont(l_extendedprice, 0.99), 6) AS q99,
  max(l_extendedprice) AS max FROM lineitem GROUP BY l_returnflag""",
    "price_trend": f"""{_ON_MART}
SELECT CAST(date AS VARCHAR) AS date, symbol, company_name, adjusted_close_price FROM mart""",
    "newest_first": f"{_ON_MART} SELECT {_MART_OUT} FROM mart",
    "sector_options": f"{_ON_MART} SELECT DISTINCT sector_group FROM mart",
    "top3_symbols": f"{_ON_MART} SELECT symbol FROM {_FIRST3}",
    "sector_filter": f"""{_ON_MART} SELECT {_MART_OUT} FROM mart
WHERE sector_group IN ({_SECTOR_LIST}) AND symbol IN ('B1.PR', 'B2.SM', 'B3.EC', 'B25.LG')""",
    "payload_flatten": f"{_SILVER} SELECT {_SILVER_OUT} FROM prices",
    "flatten_events": f"""{_ON_PAYLOADS}
SELECT event_id, symbol, d AS price_date, try_cast(t_open AS DOUBLE) AS open, try_cast(t_high AS DOUBLE) AS high,
  try_cast(t_low AS DOUBLE) AS low, try_cast(t_close AS DOUBLE) AS "close",
  try_cast(t_adjusted AS DOUBLE) AS adjusted_close, try_cast(t_volume AS BIGINT) AS volume
FROM accepted WHERE is_kept""",
    "payload_classify": f"""{_ON_PAYLOADS}
SELECT event_id, symbol, etype IS NULL AS success, etype AS error_type,
  CASE WHEN etype = 'JSONDecodeError' THEN 'Invalid JSON response from API'
    WHEN etype = 'API_INVALID_CALL' THEN 'API business error: ' || error
    WHEN etype = 'APIValueError' AND note LIKE '%API call frequency%'
      THEN 'Alpha Vantage Rate Limit Exceeded (5 calls/min or 500/day).'
    WHEN etype = 'AttributeError' THEN 'series of ' || symbol || ' is no map of rows'
    WHEN etype = 'APIValueError' THEN 'API response for ' || symbol || ' is malformed or empty.' END AS error_msg,
  CASE WHEN etype IS NULL THEN CAST(n_days AS BIGINT) END AS record_count FROM judged""",
    "payload_validate": f"""{_ON_PAYLOADS}
SELECT event_id, symbol, failed IS NULL AS is_valid, failed AS failed_check,
  CASE failed WHEN 'unreadable' THEN 'not a JSON object' WHEN 'error_marker' THEN error
    WHEN 'missing_series' THEN 'Weekly Adjusted Time Series' WHEN 'malformed_series' THEN 'Weekly Adjusted Time Series'
    WHEN 'empty_series' THEN 'no rows'
    WHEN 'invalid_date' THEN '1' WHEN 'missing_field' THEN '6. volume'
    WHEN 'not_numeric' THEN CAST(n_bad AS VARCHAR)
  END AS detail FROM judged""",
    "payload_screen": f"{_ON_PAYLOADS} SELECT event_id, symbol, reject AS reject_reason FROM judged",
    "success_split": f"""{_ON_PAYLOADS}
SELECT event_id, CASE WHEN etype IS NULL THEN 'ok' ELSE 'failed' END AS side FROM judged""",
    "failures_by_type": f"""{_ON_PAYLOADS}
SELECT etype AS error_type, count(*) AS n_failed FROM judged WHERE etype IS NOT NULL GROUP BY etype""",
    "failed_symbols": f"""{_ON_PAYLOADS}
SELECT symbol, count(*) AS n_failed FROM judged WHERE etype IS NOT NULL GROUP BY symbol""",
    "field_presence": f"""{_ON_PAYLOADS}
SELECT field, count(*) AS n_cells,
  count(try_cast(json_extract_string(obs, '$."' || field || '"') AS DOUBLE)) AS n_numbers
FROM (SELECT obs, unnest(fields) AS field FROM judged) GROUP BY field""",
    "tolerant_cast": f"""WITH texts AS (
  SELECT l_returnflag, l_linestatus, {_CAST_TEXT} AS t, l_extendedprice, l_linenumber FROM lineitem),
typed AS (
  SELECT *, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+(\\.[0-9]*)?') THEN CAST(t AS DOUBLE) END AS d,
    CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN CAST(t AS BIGINT) END AS b FROM texts)
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(d) AS n_double, count(b) AS n_bigint,
  round(CAST(sum(CAST(d AS DECIMAL(18,4))) AS DOUBLE), 6) AS sum_double, CAST(sum(b) AS BIGINT) AS sum_bigint
FROM typed GROUP BY 1, 2""",
    "quality_filter": """WITH k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume FROM events)
SELECT event_type, count(*) AS n_raw,
  count(*) FILTER (WHERE event_type NOT IN ('error', 'click') AND (event_type <> 'view' OR value = 0) AND volume >= 0)
    AS n_kept,
  count(*) AS n_null_high, count(*) FILTER (WHERE event_type = 'click') AS n_null_volume
FROM k GROUP BY event_type""",
    "upsert_ignore": f"""{_SPLIT}
SELECT {_SILVER_OUT} FROM (SELECT * FROM stored UNION ALL SELECT * EXCLUDE (l_returnflag) FROM fresh)""",
    "upsert_new_rows": f"""{_SPLIT}
SELECT symbol, count(*) AS n_new, CAST(sum(volume) AS BIGINT) AS new_volume FROM fresh GROUP BY symbol""",
    "batch_dedup": """SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, round(value, 6) AS value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
    "latest_per_symbol": """SELECT user_id, event_id, round(value, 6) AS value, event_type
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "audit_metrics": f"""{_ON_PAYLOADS}
SELECT symbol, CAST(sum(n_days) AS BIGINT) AS rows_processed, count(*) FILTER (WHERE is_kept) AS rows_loaded,
  CAST(sum(n_days) AS BIGINT) - count(*) FILTER (WHERE is_kept) AS rows_rejected
FROM accepted GROUP BY symbol""",
    "universe_semi": f"""{_SILVER}
SELECT {_SILVER_OUT} FROM prices WHERE symbol IN (SELECT {_UNIVERSE})""",
    "symbol_of_path": """SELECT split_part(regexp_replace(url, '^https?://', ''), '/', 3) AS symbol, count(*) AS n_pages
FROM pages GROUP BY 1""",
    "csv_tolerant": """SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_quantity,
  count(*) FILTER (WHERE l_returnflag = 'R') AS n_bad_rows, CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey
FROM lineitem GROUP BY l_returnflag""",
    "bronze_round_trip": f"{_SILVER} SELECT {_SILVER_OUT} FROM prices",
    "bronze_latest": f"""{_SILVER},
landed AS (SELECT *, symbol LIKE '%ec' AS again, year(price_date) AS y FROM prices)
SELECT symbol, CASE WHEN late THEN '2002-01-08' ELSE '2002-01-01' END AS date,
  CASE WHEN late AND n_late > 0 THEN '103000' ELSE '000000' END AS run,
  CASE WHEN late AND n_late > 0 THEN y_late ELSE y_all END AS n_payloads,
  CASE WHEN late AND n_late > 0 THEN n_late ELSE n_all END AS n_rows
FROM (SELECT symbol, bool_or(again) AS late, count(*) AS n_all, count(*) FILTER (y > 1994) AS n_late,
  count(DISTINCT y) AS y_all, count(DISTINCT y) FILTER (y > 1994) AS y_late FROM landed GROUP BY symbol)""",
    "load_rejects": f"""{_ON_PAYLOADS}
SELECT symbol, reject AS reject_reason, count(*) AS n_payloads, CAST(sum(length(payload)) AS BIGINT) AS n_chars
FROM (SELECT DISTINCT event_id, symbol, reject, payload FROM judged WHERE reject IS NOT NULL) GROUP BY 1, 2""",
    "stream_rejects": f"""{_ON_PAYLOADS},
audit AS (SELECT symbol, CAST(sum(n_days) AS BIGINT) AS p, count(*) FILTER (WHERE is_kept) AS i FROM accepted GROUP BY symbol),
turned AS (SELECT symbol, count(*) AS n FROM judged WHERE reject IS NOT NULL GROUP BY symbol)
SELECT symbol, coalesce(p, 0) AS rows_processed, coalesce(i, 0) AS rows_inserted, coalesce(p - i, 0) AS rows_rejected,
  coalesce(n, 0) AS n_rejected FROM audit FULL JOIN turned USING (symbol)""",
    "silver_contracts": f"""{_ON_PAYLOADS}, {SILVER} AS (SELECT DISTINCT ON (symbol, d) d AS price_date, symbol,
  try_cast(t_adjusted AS DOUBLE) AS adjusted_close, try_cast(t_volume AS BIGINT) AS volume FROM accepted WHERE is_kept)
{_checks(SILVER_CONTRACTS)}""",
    "gold_catalog": f"""{_SILVER}
SELECT upper(symbol) AS symbol, count(*) AS n_weeks, CAST(sum(volume) AS BIGINT) AS total_volume,
  CAST(max(adjusted_close) AS DOUBLE) AS top_price FROM prices GROUP BY 1""",
    "landing_retry": f"""{_SILVER}
SELECT symbol, count(DISTINCT year(price_date)) AS n_payloads, count(*) AS n_rows FROM prices GROUP BY symbol""",
    "stream_newest": f"""{_SILVER}
SELECT DISTINCT symbol, CASE WHEN symbol LIKE '%ec' THEN '2002-01-08' ELSE '2002-01-01' END AS date,
  CASE WHEN symbol LIKE '%ec' THEN '103000' ELSE '000000' END AS run FROM prices""",
    "gold_incremental": f"{_SILVER}, {_STG}, {_FACT} SELECT * FROM fact",
    "zscore_merged": f"""{_SCORED}
SELECT CAST(date AS VARCHAR) AS date, symbol, adjusted_close_price, round(z, 6) AS z_score FROM scored""",
    "mart_pruned": f"""{_ON_MART} SELECT {_MART_OUT} FROM mart WHERE sector_group IN ({_SECTOR_LIST})
  AND date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""",
    "gold_published": f"""{_ON_MART} SELECT {_MART_OUT} FROM mart WHERE year(date) < 1996""",
    "chart_series": f"""{_ON_MART}, ends AS (SELECT min(date) AS low, max(date) - min(date) + 1 AS width FROM mart),
binned AS (SELECT symbol, date, adjusted_close_price AS p, (date - low) * 50 // width AS bin FROM mart, ends),
ranked AS (SELECT *, row_number() OVER (in_bin ORDER BY date) AS a, row_number() OVER (in_bin ORDER BY date DESC) AS b,
    row_number() OVER (in_bin ORDER BY p, date) AS c, row_number() OVER (in_bin ORDER BY p DESC, date) AS d
  FROM binned WINDOW in_bin AS (PARTITION BY symbol, bin))
SELECT symbol, CAST(bin AS BIGINT) AS bin, CAST(date AS VARCHAR) AS date, p AS adjusted_close_price
FROM ranked WHERE 1 IN (a, b, c, d)""",
    "seed_file": f"{_GOLD} SELECT * FROM dim_stock",
    "payload_transport": f"""{_ON_PAYLOADS}, typed AS (SELECT judged.*, ev.k, ev.event_type FROM judged JOIN ev USING (event_id)),
named AS (SELECT *, event_type = 'error' AND k < 40 AS lost FROM typed)
SELECT CASE WHEN lost THEN 'RequestException' ELSE etype END AS error_type,
  CASE WHEN lost THEN 'Network/MTU Error: timed out after ' || k
    WHEN etype = 'JSONDecodeError' THEN 'Invalid JSON response from API'
    WHEN etype = 'API_INVALID_CALL' THEN 'API business error: ' || error
    WHEN etype = 'APIValueError' AND note LIKE '%API call frequency%'
      THEN 'Alpha Vantage Rate Limit Exceeded (5 calls/min or 500/day).'
    WHEN etype = 'AttributeError' THEN 'series of ' || symbol || ' is no map of rows'
    WHEN etype = 'APIValueError' THEN 'API response for ' || symbol || ' is malformed or empty.' END AS error_msg,
  count(*) AS n_payloads FROM named GROUP BY 1, 2""",
    "column_types": f"""{_ON_MART}, counted AS (SELECT count(*) AS n, count(*) FILTER (low_price <> 0) AS v,
    count(*) FILTER (open_price <> 0) AS w FROM stg),
listed(table_name, column_name, type, n_values) AS (
  {" UNION ALL ".join(
      f"SELECT '{t}', '{c}', '{k}', {n} FROM counted" for t, c, k, n in [
          ("staging", "trade_date", "date", "n"), ("staging", "trade_volume", "bigint", "n"),
          ("staging", "_processing_date", "date", "n"),
          *[("staging", f"{c}_price", "decimal(15,4)", "n") for c in ("open", "high", "low", "close", "adjusted_close")],
          *[("fact", f"{c}_price", "decimal(15,4)", "n") for c in ("open", "high", "low", "adjusted_close")],
          ("fact", "trade_volume", "bigint", "n"), ("fact", "weekly_return_abs", "decimal(16,4)", "n"),
          ("fact", "weekly_return_pct", "decimal(20,4)", "w"), ("fact", "trading_range_abs", "decimal(16,4)", "n"),
          ("fact", "volatility_pct", "decimal(20,4)", "v"), ("mart", "date", "date", "n"),
          ("mart", "adjusted_close_price", "decimal(15,4)", "n"), ("mart", "weekly_return_pct", "decimal(20,4)", "w"),
          ("mart", "volatility_pct", "decimal(20,4)", "v"), ("mart", "trade_volume", "bigint", "n"),
      ]
  )}) SELECT * FROM listed""",
    "silver_load": f"{_SILVER} SELECT {_SILVER_OUT} FROM prices",
    "audit_table": f"""{_ON_PAYLOADS}
SELECT 'transform_load_silver' AS pipeline_step, symbol AS stock_symbol,
  CAST(sum(n_days) AS BIGINT) AS rows_processed, count(*) FILTER (WHERE is_kept) AS rows_inserted,
  CAST(sum(n_days) AS BIGINT) - count(*) FILTER (WHERE is_kept) AS rows_rejected
FROM accepted GROUP BY symbol""",
    "load_measured": f"""{_ON_PAYLOADS}, new_rows AS (SELECT DISTINCT ON (symbol, d) d AS price_date, symbol,
  try_cast(t_adjusted AS DOUBLE) AS adjusted_close, try_cast(t_volume AS BIGINT) AS volume FROM accepted WHERE is_kept)
SELECT unnest(['rows_processed', 'rows_loaded', 'n_rejected', 'rows_new', 'price_date not_null', 'symbol not_null',
    'adjusted_close not_null', 'volume not_null', 'volume has_type']) AS figure,
  unnest([(SELECT CAST(sum(n_days) AS BIGINT) FROM accepted), (SELECT count(*) FROM accepted WHERE is_kept),
    (SELECT count(*) FROM judged WHERE reject IS NOT NULL), (SELECT count(*) FROM new_rows),
    (SELECT count(*) - count(price_date) FROM new_rows), (SELECT count(*) - count(symbol) FROM new_rows),
    (SELECT count(*) - count(adjusted_close) FROM new_rows), (SELECT count(*) - count(volume) FROM new_rows), 0]) AS value""",
    "silver_bucketed": f"""{_SPLIT}
SELECT {_SILVER_OUT} FROM (SELECT * FROM stored UNION ALL SELECT * EXCLUDE (l_returnflag) FROM fresh)""",
    "dq_load_keys": f"""{_SPLIT}, broken AS (
  SELECT price_date, symbol FROM batch GROUP BY ALL HAVING count(*) > 1
  UNION SELECT price_date, symbol FROM batch SEMI JOIN stored USING (price_date, symbol))
SELECT '{SILVER}' AS table_name, 'price_date,symbol' AS column_name, 'unique_combination' AS check_name,
  'error' AS severity, count(*) AS n_violations FROM broken
UNION ALL SELECT '{SILVER}', 'symbol', 'relationship', 'error', count(*) FROM batch
WHERE symbol NOT IN (SELECT {_SYMBOL} FROM part WHERE p_type <> 'ECONOMY')""",
    "stream_pick_up": f"{_SILVER} SELECT {_SILVER_OUT} FROM prices",
    "dq_not_null": _checks(R.DQ_NOT_NULL),
    "dq_unique": _checks(R.DQ_UNIQUE),
    "dq_unique_combination": _checks(R.DQ_UNIQUE_COMBINATION),
    "dq_relationships": _checks(R.DQ_RELATIONSHIPS),
    "dq_accepted_values": _checks(R.DQ_ACCEPTED),
    "dq_between": _checks(R.DQ_BETWEEN),
    "dq_matches": _checks(R.DQ_MATCHES),
    "dq_type": _checks(R.DQ_TYPE),
    "dq_calendar": f"""WITH dim_date AS (SELECT year(d) AS year, weekofyear(d) AS week_number, quarter(d) AS quarter
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)) {_checks(CALENDAR_CONTRACTS)}""",
    "dq_orphans": """SELECT l_partkey, count(*) AS n_rows FROM lineitem
WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY l_partkey""",
    "dq_severities": f"""SELECT severity, count(*) AS n_checks, CAST(sum(n_violations) AS BIGINT) AS n_violations
FROM ({_checks([*R.DQ_ACCEPTED, *R.DQ_BETWEEN, *R.DQ_MATCHES])}) WHERE n_violations > 0 GROUP BY severity""",
    "dq_report": _report(),
}
