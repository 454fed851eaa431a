"""Every registered query: a callable on (session, folder of tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas as S
from candlewick.functions import calendar_columns, symbol_from_path, tolerant_bigint, tolerant_double
from candlewick.operators import checks as Q
from candlewick.operators.payload import (
    classify,
    dated,
    failure_counts,
    parse,
    quality_rule,
    screen,
    split_outcomes,
    validate,
)
from candlewick.operators.ranking import distinct_sorted, first_n, first_per_key, insert_or_ignore, rows_where, upserted
from candlewick.operators.series import flatten, load_counts, standardise, tolerant_casts, typed_rows
from candlewick.operators.stats import grouped_quantiles, share_of_total, with_zscore
from candlewick.operators.universe import in_universe, universe
from candlewick.sources.bronze import latest_bronze, read_bronze, write_bronze, write_packed
from candlewick.sources.files import read_csv, read_seed
from candlewick.sources.scratch import materialise, scratch_path
from candlewick.sources.tables import AUDIT, QUARANTINE, SILVER, append_silver, read_table, setup_tables
from candlewick.streaming.pickup import pick_up, refresh, track_newest, tracked_newest

from . import mart as M
from . import views as V
from .contracts import CALENDAR_CONTRACTS, SILVER_CONTRACTS
from .gold import (
    Gold,
    build_dim_date,
    build_dim_stock,
    build_gold,
    build_staging,
    check_gold,
    read_gold,
    refresh_gold,
)
from .load import bronze_to_silver, land_payloads

Query = Callable[[SparkSession, str], DataFrame]
#: Of silver tables whose loads may be too large for a broadcast.
BUCKETS = 16
RUN_TIME = "2002-01-01 00:00:00"
UNIVERSE_JSON = '["b1.pr", "b2.pr", "b3.ec", "b4.sm", "b5.st", "b25.md", "nosuch"]'
SECTORS = ["Tech & Comm", "Financial Services"]


def plain(df: DataFrame) -> DataFrame:
    """Result types that read alike in every engine: decimals as doubles, dates as text."""

    def as_plain(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return F.round(c, 6).alias(field.name)
        return c

    return df.select(*[as_plain(f) for f in df.schema])


def _gold(spark: SparkSession, folder: str, keep_fact: bool = True) -> Gold:
    return build_gold(
        V.silver(spark, folder), V.seed(spark, folder), sector_groups=V.TYPE_GROUPS, keep_fact=keep_fact
    )


def _mart(spark: SparkSession, folder: str, keep_fact: bool = False) -> DataFrame:
    """The mart; the fact is written first where a query reads it more than once."""
    return M.gold_mart(_gold(spark, folder, keep_fact))


# --- models -------------------------------------------------------------------


def stg_prices(spark, folder):
    return plain(build_staging(V.silver(spark, folder)).drop("dbt_load_timestamp", "_ingestion_timestamp"))


def dim_date(spark, folder):
    days = V.table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("trade_date"))
    return plain(build_dim_date(days).drop("created_at"))


def calendar_quarters(spark, folder):
    orders = V.table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    parts = calendar_columns(day)
    return plain(
        orders.groupBy(
            parts["year"].alias("year"),
            F.quarter(day).alias("quarter"),
            parts["is_quarter_reporting_month"].alias("is_quarter_reporting_month"),
        ).agg(F.count(F.lit(1)).alias("n_orders"), F.count_if(parts["is_weekend"]).alias("n_weekend"))
    )


def dim_stock(spark, folder):
    staging = build_staging(V.silver(spark, folder))
    return plain(build_dim_stock(staging, V.seed(spark, folder), V.TYPE_GROUPS).drop("created_at"))


def dim_source(spark, folder):
    gold = _gold(spark, folder, keep_fact=False)
    loaded = gold.fact.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("trade_volume").alias("total_volume")
    )
    return plain(gold.dim_source.drop("created_at").join(loaded, "source_id", "left"))


def fact_prices(spark, folder):
    return plain(_gold(spark, folder, keep_fact=False).fact.drop("load_timestamp"))


def gold_mart(spark, folder):
    return plain(M.gold_mart(_gold(spark, folder, keep_fact=False), ordered=True))


# --- mart ---------------------------------------------------------------------


def sector_performance(spark, folder):
    """Mean return, mean volatility and volume per sector group."""
    return plain(
        _mart(spark, folder)
        .groupBy("sector_group")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(F.col("weekly_return_pct").cast("double")).alias("avg_weekly_return"),
            F.avg(F.col("volatility_pct").cast("double")).alias("avg_volatility"),
            F.sum("trade_volume").alias("total_volume"),
        )
    )


def zscore(spark, folder):
    scored = with_zscore(_mart(spark, folder, keep_fact=True), "symbol", "adjusted_close_price")
    return plain(scored.select("date", "symbol", "adjusted_close_price", "z_score"))


def zscore_events(spark, folder):
    scored = with_zscore(V.table(spark, folder, "events"), "user_id", "value")
    return plain(scored.select("event_id", "user_id", "value", "z_score"))


def anomaly_count(spark, folder):
    return plain(M.anomaly_count(_mart(spark, folder, keep_fact=True)))


def anomaly_count_lines(spark, folder):
    """Order lines far from their supplier's mean price."""
    rows = V.table(spark, folder, "lineitem").select("l_suppkey", "l_extendedprice")
    return plain(M.anomaly_count(rows, "l_suppkey", "l_extendedprice"))


def anomalies(spark, folder):
    scored = with_zscore(_mart(spark, folder, keep_fact=True), "symbol", "adjusted_close_price")
    return plain(
        scored.filter(F.abs("z_score") > S.ANOMALY_THRESHOLD).select("date", "symbol", "adjusted_close_price", "z_score")
    )


def kpis(spark, folder):
    return plain(M.kpis(_mart(spark, folder, keep_fact=True)))


def kpis_default_selection(spark, folder):
    """Indicators for the dashboard's first view: chosen sectors, first three symbols of them."""
    chosen = M.select_rows(_mart(spark, folder, keep_fact=True), SECTORS)
    return plain(M.kpis(in_universe(chosen, first_n(chosen, "symbol", 3))))


def kpis_empty_selection(spark, folder):
    return plain(M.kpis(M.select_rows(_mart(spark, folder), [], [])))


def volume_share(spark, folder):
    return plain(M.volume_share(_mart(spark, folder)))


def volume_share_lines(spark, folder):
    rows = V.table(spark, folder, "lineitem").select(
        "l_suppkey", F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return plain(share_of_total(rows, "l_suppkey", "quantity", "quantity_share"))


def volatility_quartiles(spark, folder):
    return plain(M.volatility_spread(_mart(spark, folder)))


def price_quantiles_lines(spark, folder):
    rows = V.table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").cast(S.PRICE).alias("price")
    )
    return plain(grouped_quantiles(rows, "l_returnflag", "price", (0.1, 0.5, 0.9, 0.99)))


def price_trend(spark, folder):
    return plain(M.price_trend(_mart(spark, folder)))


def newest_first(spark, folder):
    return plain(M.newest_first(_mart(spark, folder)))


def sector_options(spark, folder):
    return distinct_sorted(_mart(spark, folder), "sector_group")


def top3_symbols(spark, folder):
    return first_n(M.select_rows(_mart(spark, folder), SECTORS), "symbol", 3)


def sector_filter(spark, folder):
    chosen = M.select_rows(_mart(spark, folder), SECTORS, ["B1.PR", "B2.SM", "B3.EC", "B25.LG"])
    return plain(chosen)


# --- payloads -------------------------------------------------------------------


def payload_flatten(spark, folder):
    payloads = V.price_payloads(V.silver(spark, folder))
    rows = standardise(tolerant_casts(flatten(parse(payloads))), RUN_TIME)
    return plain(rows.drop("_ingestion_timestamp"))


def flatten_events(spark, folder):
    """Clean rows of the event payloads that a load accepts."""
    typed = typed_rows(screen(V.event_payloads(spark, folder)), ("event_id", "symbol"))
    kept = standardise(typed, RUN_TIME, keep=("event_id",))
    return plain(kept.drop("_ingestion_timestamp", "_data_source", "_processing_date"))


def payload_classify(spark, folder):
    rows = classify(V.event_payloads(spark, folder))
    return rows.select("event_id", "symbol", "success", "error_type", "error_msg", "record_count")


def payload_validate(spark, folder):
    rows = validate(V.event_payloads(spark, folder))
    return rows.select("event_id", "symbol", "is_valid", "failed_check", "detail")


def payload_screen(spark, folder):
    rows = screen(V.event_payloads(spark, folder))
    return rows.select("event_id", "symbol", "reject_reason")


def success_split(spark, folder):
    ok, failed = split_outcomes(classify(V.event_payloads(spark, folder)))
    return ok.select("event_id", F.lit("ok").alias("side")).unionByName(
        failed.select("event_id", F.lit("failed").alias("side"))
    )


def failures_by_type(spark, folder):
    return failure_counts(classify(V.event_payloads(spark, folder)))


def failed_symbols(spark, folder):
    failed = rows_where(classify(V.event_payloads(spark, folder)), ~F.col("success"))
    return failed.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_failed"))


def field_presence(spark, folder):
    """How often each numbered field occurs in the event payloads, and how often it is a number."""
    rows = dated(parse(V.event_payloads(spark, folder)))
    cells = rows.select(F.explode("row").alias("field", "text")).filter(F.col("field").rlike(S.NUMBERED_FIELD))
    return cells.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count(tolerant_double("text")).alias("n_numbers")
    )


def tolerant_cast(spark, folder):
    text = (
        F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice").cast("string"))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), F.col("l_linenumber").cast("string")))
        .when(F.col("l_returnflag") == "R", F.concat(F.col("l_linenumber").cast("string"), F.lit(".5d")))
        .otherwise(F.concat(F.lit("-"), F.col("l_linenumber").cast("string")))
    )
    rows = V.table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", text.alias("text"))
    return plain(
        rows.groupBy("l_returnflag", "l_linestatus").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(tolerant_double("text")).alias("n_double"),
            F.count(tolerant_bigint("text")).alias("n_bigint"),
            F.sum(tolerant_double("text").cast("decimal(18,4)")).cast("double").alias("sum_double"),
            F.sum(tolerant_bigint("text")).alias("sum_bigint"),
        )
    )


def quality_filter(spark, folder):
    """Rows before and after the quality rule, on events read as untyped prices."""
    value, is_type = F.col("value").cast("string"), lambda t: F.col("event_type") == t
    raw = V.table(spark, folder, "events").select(
        "event_type",
        F.col("ts").cast("date").cast("string").alias("price_date"),
        F.when(is_type("error"), "NaN").when(is_type("signup"), "-1").otherwise(value).alias("open"),
        F.lit("x").alias("high"),
        F.lit(None).cast("string").alias("low"),
        F.when(is_type("view"), F.concat(F.lit("-"), value)).otherwise(value).alias("close"),
        value.alias("adjusted_close"),
        F.when(is_type("click"), F.concat(F.get_json_object("props", "$.k"), F.lit(".5")))
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("volume"),
    )
    typed = tolerant_casts(raw)
    return plain(
        typed.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n_raw"),
            F.count_if(quality_rule(F.col("open"), F.col("close"), F.col("volume"))).alias("n_kept"),
            F.count_if(F.col("high").isNull()).alias("n_null_high"),
            F.count_if(F.col("volume").isNull()).alias("n_null_volume"),
        )
    )


# --- loading --------------------------------------------------------------------


def _split_load(spark, folder):
    """Finished lines as the stored table, open lines as a batch with up to three rows per key."""
    order_lines = V.lines(spark, folder)
    stored = materialise(V.prices(order_lines.filter(F.col("l_linestatus") == "F")), "stored")
    batch = V.prices(order_lines.filter(F.col("l_linestatus") == "O"), extra=("l_returnflag",))
    return stored, batch


def upsert_ignore(spark, folder):
    stored, batch = _split_load(spark, folder)
    return plain(upserted(stored, batch, S.SILVER_KEY, ["l_returnflag"]).drop("_ingestion_timestamp"))


def upsert_new_rows(spark, folder):
    stored, batch = _split_load(spark, folder)
    fresh = insert_or_ignore(stored, batch, S.SILVER_KEY, ["l_returnflag"])
    return plain(fresh.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_new"), F.sum("volume").alias("new_volume")))


def batch_dedup(spark, folder):
    """First event per user and day."""
    events = V.table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    first = first_per_key(events, ["user_id", "day"], ["ts", "event_id"])
    return plain(first.select("user_id", "day", "event_id", "value"))


def latest_per_symbol(spark, folder):
    events = V.table(spark, folder, "events")
    latest = first_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return plain(latest.select("user_id", "event_id", "value", "event_type"))


def audit_metrics(spark, folder):
    counts = load_counts(typed_rows(screen(V.event_payloads(spark, folder))))
    return counts.withColumn("rows_rejected", F.col("rows_processed") - F.col("rows_loaded"))


def universe_semi(spark, folder):
    tracked = in_universe(V.silver(spark, folder), universe(spark, UNIVERSE_JSON))
    return plain(tracked.drop("_ingestion_timestamp"))


def symbol_of_path(spark, folder):
    """Symbol of each page's URL path read as an object key, with the pages it covers."""
    pages = V.table(spark, folder, "pages").select(
        symbol_from_path(F.regexp_replace("url", r"^https?://", "")).alias("symbol")
    )
    return pages.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_pages"))


# --- files, tables and streams ----------------------------------------------------


def csv_tolerant(spark, folder):
    """Lines written as CSV, with text in a numeric column of returned ones, and read back."""
    path = scratch_path(spark, "csv")
    quantity = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    V.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", quantity.alias("l_quantity")
    ).write.option("header", True).csv(path)
    schema = T.StructType.fromDDL("l_orderkey bigint, l_linenumber int, l_returnflag string, l_quantity double")
    rows = read_csv(spark, path, schema, corrupt_column="bad_row")
    return plain(
        rows.groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("l_quantity").alias("n_quantity"),
            F.count("bad_row").alias("n_bad_rows"),
            F.sum("l_orderkey").alias("sum_orderkey"),
        )
    )


def bronze_round_trip(spark, folder):
    """Prices landed as payload files and flattened again from the files."""
    path = scratch_path(spark, "bronze")
    land_payloads(V.price_payloads(V.silver(spark, folder)), path, RUN_TIME)
    rows = standardise(typed_rows(screen(read_bronze(spark, path))), RUN_TIME)
    return plain(rows.drop("_ingestion_timestamp"))


def bronze_latest(spark, folder):
    """Three landings, two of them on one day: the newest of each symbol with all its payloads and rows."""
    path = scratch_path(spark, "bronze")
    rows = materialise(V.silver(spark, folder), "prices")
    packed = V.price_payloads(rows)
    write_bronze(packed, path, RUN_TIME)
    write_bronze(packed.filter(F.col("symbol").endswith("ec")), path, "2002-01-08 00:00:00")
    later = rows.filter(F.col("symbol").endswith("ec") & (F.year("price_date") > 1994))
    write_bronze(V.price_payloads(later), path, "2002-01-08 10:30:00")
    newest = parse(latest_bronze(spark, path))
    return plain(
        newest.groupBy("symbol", "date", "run").agg(
            F.count(F.lit(1)).alias("n_payloads"), F.sum(F.size("_series")).cast("bigint").alias("n_rows")
        )
    )


def landing_retry(spark, folder):
    """A run that landed some symbols only, is run again, and once more: each payload is there once."""
    path = scratch_path(spark, "bronze")
    packed = materialise(V.price_payloads(V.silver(spark, folder)), "payloads")
    for part in (packed.filter(F.col("symbol").endswith("ec")), packed, packed):
        write_bronze(part, path, RUN_TIME)
    landed = parse(read_bronze(spark, path))
    return plain(
        landed.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_payloads"), F.sum(F.size("_series")).cast("bigint").alias("n_rows"))
    )


def stream_newest(spark, folder):
    """Newest landing of each symbol, kept as stream state over three landings and as many starts."""
    path, checkpoint, out = (scratch_path(spark, name) for name in ("bronze", "newest", "newest-table"))
    packed = materialise(V.price_payloads(V.silver(spark, folder)), "payloads")
    some = packed.filter(F.col("symbol").endswith("ec"))
    for part, run_time in ((some, "2002-01-08 10:30:00"), (packed, RUN_TIME), (some, "2002-01-08 00:00:00")):
        write_bronze(part, path, run_time)
        track_newest(spark, path, checkpoint, out)
    return tracked_newest(spark, out)


def _fresh_schema(spark, buckets=None):
    name = f"cw_{uuid.uuid4().hex}"
    setup_tables(spark, name, scratch_path(spark, name), buckets)
    return name


def _event_load(spark, folder):
    return V.event_payloads(spark, folder).select(
        "symbol",
        "payload",
        F.lit(RUN_TIME).cast("timestamp").alias("loaded_at"),
        F.format_string("event-%012d", "event_id").alias("file_path"),
    )


def load_rejects(spark, folder):
    """Event payloads loaded twice: what the quarantine holds, by symbol and reason."""
    schema = _fresh_schema(spark)
    for _ in range(2):
        bronze_to_silver(_event_load(spark, folder), schema, RUN_TIME)
    kept = read_table(spark, schema, QUARANTINE)
    return kept.groupBy("symbol", "reject_reason").agg(
        F.count(F.lit(1)).alias("n_payloads"), F.sum(F.length("payload")).alias("n_chars")
    )


def stream_rejects(spark, folder):
    """Event payloads as files, bad ones included, picked up by the stream: kept, filtered and rejected per symbol.

    The symbols are users, whose number grows with the events, so they share files.
    """
    path, schema = scratch_path(spark, "bronze"), _fresh_schema(spark)
    write_packed(V.event_payloads(spark, folder), path, RUN_TIME)
    pick_up(spark, path, schema, scratch_path(spark, "pickup"), RUN_TIME, packed=True)
    audit = read_table(spark, schema, AUDIT).select(
        F.col("stock_symbol").alias("symbol"), "rows_processed", "rows_inserted", "rows_rejected"
    )
    turned = read_table(spark, schema, QUARANTINE).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rejected"))
    return audit.join(turned, "symbol", "full").na.fill(0)


def silver_contracts(spark, folder):
    """The contracts of silver, on a table loaded from the event payloads."""
    schema = _fresh_schema(spark)
    bronze_to_silver(_event_load(spark, folder), schema, RUN_TIME)
    return Q.run_checks({SILVER: read_table(spark, schema, SILVER)}, SILVER_CONTRACTS)


def gold_catalog(spark, folder):
    """Catalog models built from the early weeks, then refreshed after the later ones have landed."""
    path, schema = scratch_path(spark, "bronze"), _fresh_schema(spark)
    checkpoint, rows = scratch_path(spark, "pickup"), materialise(V.silver(spark, folder), "prices")
    early = F.year("price_date") < 1998
    for part, landed in ((rows.filter(early), RUN_TIME), (rows.filter(~early), "2002-01-08 00:00:00")):
        write_bronze(V.price_payloads(part), path, landed)
        refresh(spark, path, schema, V.seed(spark, folder), checkpoint, RUN_TIME)
    fact = read_table(spark, schema, "fact_adjusted_prices").join(read_table(spark, schema, "dim_stock"), "stock_id")
    return plain(
        fact.groupBy("symbol").agg(
            F.count(F.lit(1)).alias("n_weeks"),
            F.sum("trade_volume").alias("total_volume"),
            F.max("adjusted_close_price").alias("top_price"),
        )
    )


def _three_loads(spark, folder):
    """Catalog models brought up to date after each of three loads: early weeks, later weeks, and all weeks of new symbols."""
    path, schema = scratch_path(spark, "bronze"), _fresh_schema(spark)
    checkpoint, rows, seed = scratch_path(spark, "pickup"), materialise(V.silver(spark, folder), "prices"), V.seed(spark, folder)
    early, late_symbol = F.year("price_date") < 1996, F.col("symbol").endswith(".pr")
    gold = None
    for day, part in enumerate((rows.filter(early & ~late_symbol), rows.filter(~early & ~late_symbol), rows.filter(late_symbol))):
        write_bronze(V.price_payloads(part), path, f"2002-01-0{day + 1} 00:00:00")
        pick_up(spark, path, schema, checkpoint, RUN_TIME)
        gold = refresh_gold(spark, schema, seed, V.TYPE_GROUPS)
    return gold


def gold_incremental(spark, folder):
    """The fact after three loads, each of which rebuilt what it touched."""
    return plain(_three_loads(spark, folder).fact.drop("load_timestamp", *S.GOLD_PARTS))


def zscore_merged(spark, folder):
    """Z-scores after three loads, from the stored moments."""
    scored = M.stored_zscores(_three_loads(spark, folder))
    return plain(scored.select("date", "symbol", "adjusted_close_price", "z_score"))


def _stored_gold(spark, folder):
    return build_gold(V.silver(spark, folder), V.seed(spark, folder), _fresh_schema(spark), V.TYPE_GROUPS)


def mart_pruned(spark, folder):
    """Two sector groups in eighteen months, from a fact that is stored by year and stock part."""
    return plain(M.select_rows(M.gold_mart(_stored_gold(spark, folder)), SECTORS, since="1996-01-01", until="1997-06-30"))


def gold_published(spark, folder):
    """Models whose next build fails after its staging: what was published before stays readable."""
    schema, rows, seed = _fresh_schema(spark), materialise(V.silver(spark, folder), "prices"), V.seed(spark, folder)
    build_gold(rows.filter(F.year("price_date") < 1996), seed, schema, V.TYPE_GROUPS)
    broken = seed.withColumn("company_name", F.raise_error(F.concat(F.lit("no name for "), "symbol")).cast("string"))
    try:
        build_gold(rows, broken, schema, V.TYPE_GROUPS)
    except PySparkException:
        return plain(M.gold_mart(read_gold(spark, schema)))
    raise RuntimeError("the build should have failed")


def chart_series(spark, folder):
    """Price lines thinned to the rows that a chart of fifty bins shows."""
    return plain(M.chart_series(_mart(spark, folder, keep_fact=True), 50))


def seed_file(spark, folder):
    """The metadata written as CSV and read back as a seed, which the stock dimension is built from."""
    path = scratch_path(spark, "seed")
    V.seed(spark, folder).write.option("header", True).csv(path)
    staging = build_staging(V.silver(spark, folder))
    return plain(build_dim_stock(staging, read_seed(spark, path), V.TYPE_GROUPS).drop("created_at"))


def payload_transport(spark, folder):
    """Outcomes where every error event with a low number stands for a request that failed."""
    events = V.table(spark, folder, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    lost = F.when((F.col("event_type") == "error") & (F.col("k") < 40), F.concat(F.lit("timed out after "), F.col("k").cast("string")))
    payloads = V.event_payloads(spark, folder).join(events.select("event_id", lost.alias("lost")), "event_id")
    rows = classify(payloads, transport_error="lost")
    return rows.groupBy("error_type", "error_msg").agg(F.count(F.lit(1)).alias("n_payloads"))


def column_types(spark, folder):
    """Types that the models give their columns, with the number of values."""
    gold = _gold(spark, folder)
    parts = []
    for name, df in (("staging", gold.staging), ("fact", gold.fact), ("mart", M.gold_mart(gold))):
        wanted = [f.name for f in df.schema if isinstance(f.dataType, (T.DecimalType, T.DateType, T.LongType))]
        cells = [F.struct(F.lit(c).alias("column_name"), F.typeof(c).alias("type"), F.col(c).isNotNull().alias("has")) for c in wanted]
        parts.append(df.select(F.lit(name).alias("table_name"), F.inline(F.array(*cells))))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("table_name", "column_name", "type").agg(F.count_if("has").alias("n_values"))


def silver_load(spark, folder):
    """Bronze files loaded twice into a silver table: the second load adds nothing."""
    path, schema = scratch_path(spark, "bronze"), _fresh_schema(spark)
    land_payloads(V.price_payloads(V.silver(spark, folder)), path, RUN_TIME)
    for _ in range(2):
        bronze_to_silver(read_bronze(spark, path), schema, RUN_TIME)
    return plain(read_table(spark, schema, SILVER).drop("_ingestion_timestamp"))


def audit_table(spark, folder):
    """Audit rows of one load of the event payloads."""
    schema = _fresh_schema(spark)
    bronze_to_silver(_event_load(spark, folder), schema, RUN_TIME)
    audit = read_table(spark, schema, AUDIT)
    return plain(audit.select("pipeline_step", "stock_symbol", "rows_processed", "rows_inserted", "rows_rejected"))


def load_measured(spark, folder):
    """Totals and row contracts of one load of the event payloads, as its writes measured them."""
    load = bronze_to_silver(_event_load(spark, folder), _fresh_schema(spark), RUN_TIME)
    totals = spark.createDataFrame(list(load.totals.items()), "figure string, value bigint")
    checks = load.report.select(F.concat_ws(" ", "column_name", "check_name").alias("figure"), F.col("n_violations").alias("value"))
    return totals.unionByName(checks)


def silver_bucketed(spark, folder):
    """Stored lines and a batch of open ones, loaded one after the other into a silver table cut by the hash of its keys."""
    schema = _fresh_schema(spark, BUCKETS)
    stored, batch = _split_load(spark, folder)
    append_silver(stored, schema)
    append_silver(insert_or_ignore(read_table(spark, schema, SILVER), batch, S.SILVER_KEY, ["l_returnflag"]), schema)
    return plain(read_table(spark, schema, SILVER).drop("_ingestion_timestamp"))


def dq_load_keys(spark, folder):
    """Uniqueness and symbols of a batch of open lines, judged against stored ones before it is loaded."""
    schema = _fresh_schema(spark, BUCKETS)
    stored, batch = _split_load(spark, folder)
    append_silver(stored, schema)
    stocks = materialise(V.seed(spark, folder).select(F.lower("symbol").alias("symbol")).distinct(), "stocks")
    checks = [Q.unique_combination(SILVER, *S.SILVER_KEY), Q.relationship(SILVER, "symbol", "dim_stock", "symbol")]
    return Q.load_checks(read_table(spark, schema, SILVER), materialise(batch, "batch"), {"dim_stock": stocks}, checks)


def stream_pick_up(spark, folder):
    """Files picked up by two runs of the stream, the second with only the later files left."""
    path, schema = scratch_path(spark, "bronze"), _fresh_schema(spark)
    checkpoint = scratch_path(spark, "pickup")
    rows = materialise(V.silver(spark, folder), "prices")
    early = F.year("price_date") < 1998
    for part, landed in ((rows.filter(early), RUN_TIME), (rows.filter(~early), "2002-01-08 00:00:00")):
        write_bronze(V.price_payloads(part), path, landed)
        pick_up(spark, path, schema, checkpoint, RUN_TIME)
    return plain(read_table(spark, schema, SILVER).drop("_ingestion_timestamp"))


# --- checks -----------------------------------------------------------------------


def _check_tables(spark, folder, checks):
    """The tables that the checks name, and no others."""
    names = {c.table for c in checks} | {str(c.options["to"]) for c in checks if "to" in c.options}
    return {name: V.table(spark, folder, name) for name in sorted(names)}


def _checked(*checks: Q.Check) -> Query:
    def query(spark, folder):
        return Q.run_checks(_check_tables(spark, folder, checks), checks)

    return query


DQ_NOT_NULL = Q.not_null("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
DQ_UNIQUE = [
    Q.unique("orders", "o_orderkey"),
    Q.unique("lineitem", "l_orderkey"),
    Q.unique("customer", "c_name"),
    Q.unique("events", "user_id"),
]
DQ_UNIQUE_COMBINATION = [
    Q.unique_combination("lineitem", "l_orderkey", "l_linenumber"),
    Q.unique_combination("lineitem", "l_partkey", "l_suppkey"),
]
DQ_RELATIONSHIPS = [
    Q.relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Q.relationship("lineitem", "l_partkey", "supplier", "s_suppkey"),
    Q.relationship("orders", "o_custkey", "customer", "c_custkey"),
    Q.relationship("nation", "n_regionkey", "region", "r_regionkey"),
]
DQ_ACCEPTED = [
    Q.accepted_values("lineitem", "l_returnflag", ["A", "N"]),
    Q.accepted_values("orders", "o_orderstatus", ["F", "O", "P"]),
    Q.accepted_values("part", "p_type", ["PROMO", "LARGE", "SMALL"]).warn(),
]
DQ_BETWEEN = [
    Q.between("customer", "c_acctbal", 0),
    Q.between("supplier", "s_acctbal", 0, 5000),
    Q.between("lineitem", "l_quantity", 10, 20, row_condition="l_returnflag = 'A'"),
    Q.between("lineitem", "l_discount", high=0.05),
]
DQ_MATCHES = [
    Q.matches("part", "p_brand", S.TICKER_PATTERN).warn(),
    Q.matches("pages", "url", r"^https?://.*"),
    Q.matches("pages", "url", r"^https://.*"),
]
DQ_TYPE = [
    Q.has_type("lineitem", "l_orderkey", "BIGINT"),
    Q.has_type("lineitem", "l_quantity", "BIGINT"),
    Q.between("lineitem", "l_quantity", 1, 45),
    Q.has_type("events", "value", "DECIMAL(15,4)"),
]


def dq_report(spark, folder):
    """The full contract report of a gold build."""
    return check_gold(_gold(spark, folder))


def dq_calendar(spark, folder):
    """Calendar ranges over the order days, with the quarter of the older design."""
    days = V.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("trade_date"))
    calendar = build_dim_date(days).withColumn("quarter", F.quarter("week_ending"))
    return Q.run_checks({"dim_date": calendar}, CALENDAR_CONTRACTS)


def dq_orphans(spark, folder):
    """Part keys of order lines that are no supplier key, with their line counts."""
    lines, suppliers = (V.table(spark, folder, name) for name in ("lineitem", "supplier"))
    return Q.orphan_keys(lines, "l_partkey", suppliers, "s_suppkey")


def dq_row_conditions(spark, folder):
    """Severity split of the fired checks."""
    checks = [*DQ_ACCEPTED, *DQ_BETWEEN, *DQ_MATCHES]
    report = Q.run_checks(_check_tables(spark, folder, checks), checks)
    fired = report.filter(F.col("n_violations") > 0)
    return fired.groupBy("severity").agg(
        F.count(F.lit(1)).alias("n_checks"), F.sum("n_violations").alias("n_violations")
    )


QUERIES: dict[str, Query] = {
    "stg_prices": stg_prices,
    "dim_date": dim_date,
    "calendar_quarters": calendar_quarters,
    "dim_stock": dim_stock,
    "dim_source": dim_source,
    "fact_prices": fact_prices,
    "gold_mart": gold_mart,
    "sector_performance": sector_performance,
    "zscore": zscore,
    "zscore_events": zscore_events,
    "anomaly_count": anomaly_count,
    "anomaly_count_lines": anomaly_count_lines,
    "anomalies": anomalies,
    "kpis": kpis,
    "kpis_default_selection": kpis_default_selection,
    "kpis_empty_selection": kpis_empty_selection,
    "volume_share": volume_share,
    "volume_share_lines": volume_share_lines,
    "volatility_quartiles": volatility_quartiles,
    "price_quantiles_lines": price_quantiles_lines,
    "price_trend": price_trend,
    "newest_first": newest_first,
    "sector_options": sector_options,
    "top3_symbols": top3_symbols,
    "sector_filter": sector_filter,
    "payload_flatten": payload_flatten,
    "flatten_events": flatten_events,
    "payload_classify": payload_classify,
    "payload_validate": payload_validate,
    "payload_screen": payload_screen,
    "success_split": success_split,
    "failures_by_type": failures_by_type,
    "failed_symbols": failed_symbols,
    "field_presence": field_presence,
    "tolerant_cast": tolerant_cast,
    "quality_filter": quality_filter,
    "upsert_ignore": upsert_ignore,
    "upsert_new_rows": upsert_new_rows,
    "batch_dedup": batch_dedup,
    "latest_per_symbol": latest_per_symbol,
    "audit_metrics": audit_metrics,
    "universe_semi": universe_semi,
    "symbol_of_path": symbol_of_path,
    "csv_tolerant": csv_tolerant,
    "bronze_round_trip": bronze_round_trip,
    "bronze_latest": bronze_latest,
    "silver_load": silver_load,
    "audit_table": audit_table,
    "load_measured": load_measured,
    "silver_bucketed": silver_bucketed,
    "dq_load_keys": dq_load_keys,
    "stream_pick_up": stream_pick_up,
    "load_rejects": load_rejects,
    "stream_rejects": stream_rejects,
    "silver_contracts": silver_contracts,
    "gold_catalog": gold_catalog,
    "landing_retry": landing_retry,
    "stream_newest": stream_newest,
    "gold_incremental": gold_incremental,
    "zscore_merged": zscore_merged,
    "mart_pruned": mart_pruned,
    "gold_published": gold_published,
    "chart_series": chart_series,
    "seed_file": seed_file,
    "payload_transport": payload_transport,
    "column_types": column_types,
    "dq_not_null": _checked(*DQ_NOT_NULL),
    "dq_unique": _checked(*DQ_UNIQUE),
    "dq_unique_combination": _checked(*DQ_UNIQUE_COMBINATION),
    "dq_relationships": _checked(*DQ_RELATIONSHIPS),
    "dq_accepted_values": _checked(*DQ_ACCEPTED),
    "dq_between": _checked(*DQ_BETWEEN),
    "dq_matches": _checked(*DQ_MATCHES),
    "dq_type": _checked(*DQ_TYPE),
    "dq_calendar": dq_calendar,
    "dq_orphans": dq_orphans,
    "dq_severities": dq_row_conditions,
    "dq_report": dq_report,
}
