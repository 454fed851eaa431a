import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.operators import first_per_key, insert_or_ignore, upserted
from candlewick.plans import SILVER_CONTRACTS, bronze_to_silver, build_gold, check_gold, land_payloads
from candlewick.plans.load import PayloadsRejected
from candlewick.operators.checks import run_checks
from candlewick.sources import append_audit, default_seed, latest_bronze, read_bronze, read_csv, read_seed, read_table
from candlewick.sources.bronze import write_bronze, write_packed
from candlewick.sources.scratch import materialise, scratch_path
from candlewick.sources.tables import AUDIT, QUARANTINE, SILVER, append_silver, compact_silver, stored_years
from candlewick.streaming import pick_up, refresh

from helpers import GOOD, NEGATIVE, SERIES, frame, payload, without

NOW = "2025-12-01 09:30:00"


def silver(spark, schema):
    rows = read_table(spark, schema, SILVER).collect()
    return {(r["symbol"], str(r["price_date"])): r for r in rows}


def test_first_value_of_a_key_stays(spark, schema):
    other = {**GOOD, "4. close": "1"}
    bronze_to_silver(frame(spark, ("A", payload({"2019-03-15": GOOD}))), schema, NOW)
    result = bronze_to_silver(
        frame(spark, ("A", payload({"2019-03-15": other, "2019-03-22": other}))), schema, "2025-12-08 09:30:00"
    )
    got = silver(spark, schema)
    assert got["A", "2019-03-15"]["close"] == Decimal("46.1250")
    assert got["A", "2019-03-22"]["close"] == Decimal("1.0000")
    row = result.counts.first()
    assert (row["rows_processed"], row["rows_loaded"], row["rows_new"]) == (2, 2, 1)


def test_loading_twice_is_loading_once(spark, schema):
    batch = frame(spark, *[(f"S{i}", payload({"2019-03-15": GOOD, "2019-03-22": GOOD})) for i in range(20)])
    bronze_to_silver(batch, schema, NOW)
    once = silver(spark, schema)
    bronze_to_silver(batch, schema, NOW)
    assert silver(spark, schema) == once and len(once) == 40


def test_duplicate_in_one_batch_keeps_the_first_file(spark, schema):
    late = {**GOOD, "4. close": "1"}
    batch = frame(spark, ("A", payload({"2019-03-15": GOOD})), ("A", payload({"2019-03-15": late})))
    result = bronze_to_silver(batch, schema, NOW)
    assert silver(spark, schema)["A", "2019-03-15"]["close"] == Decimal("46.1250")
    assert tuple(result.counts.select("rows_processed", "rows_loaded", "rows_new").first()) == (2, 2, 1)


def test_bad_payload_is_rejected_whole_and_others_go_on(spark, schema):
    batch = frame(
        spark,
        ("BAD", payload({"2019-03-15": GOOD, "2023-13-01": GOOD})),
        ("TEXT", "{bad"),
        ("GOOD", payload({"2019-03-08": NEGATIVE, "2019-03-15": GOOD})),
        ("NONE", payload({"2019-03-08": NEGATIVE})),
        ("EMPTY", payload({})),
    )
    result = bronze_to_silver(batch, schema, NOW)
    assert {r["symbol"]: r["reject_reason"] for r in result.rejected.collect()} == {
        "BAD": "invalid_date",
        "TEXT": "unreadable",
    }
    counts = {r["symbol"]: (r["rows_processed"], r["rows_loaded"]) for r in result.counts.collect()}
    assert counts == {"GOOD": (2, 1), "NONE": (1, 0), "EMPTY": (0, 0)}
    audit = {
        r["stock_symbol"]: (r["pipeline_step"], r["rows_processed"], r["rows_inserted"], r["rows_rejected"])
        for r in read_table(spark, schema, AUDIT).collect()
    }
    assert audit["GOOD"] == ("transform_load_silver", 2, 1, 1)
    assert audit["EMPTY"] == ("transform_load_silver", 0, 0, 0)


def test_kept_and_dropped_rows_make_up_the_payload(spark, schema):
    rows = {f"2023-01-{d:02d}": (NEGATIVE if d % 3 == 0 else GOOD) for d in range(1, 29)}
    counts = bronze_to_silver(frame(spark, ("A", payload(rows))), schema, NOW).counts.first()
    assert counts["rows_processed"] == 28 and counts["rows_loaded"] == 28 - 9


def test_silver_meets_its_contracts(spark, schema):
    bronze_to_silver(frame(spark, ("A", payload({"2019-03-15": GOOD}))), schema, NOW)
    report = run_checks({SILVER: read_table(spark, schema, SILVER)}, SILVER_CONTRACTS)
    assert report.filter("n_violations > 0").count() == 0


def test_hot_key_sends_one_row_per_task(spark):
    keys = ["price_date", "symbol"]
    batch = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("symbol"),
        F.lit("2019-03-15").cast("date").alias("price_date"),
        F.col("id").alias("v"),
    )
    existing = batch.filter("v = 0").select("price_date", "symbol", F.lit(-1).cast("bigint").alias("v"))
    fresh = insert_or_ignore(existing, batch, keys, ["v"])
    assert "WindowGroupLimit" in first_per_key(batch, keys, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert fresh.filter("symbol = 'HOT'").first()["v"] == 1
    assert fresh.count() == 20000 // 3 + 1 and fresh.filter("v = 0").count() == 0
    assert upserted(existing, batch, keys, ["v"]).count() == fresh.count() + 1


def test_stored_keys_are_neither_shuffled_nor_sorted(spark, schema):
    batch = spark.range(10).select(
        F.date_add(F.lit("2019-03-15").cast("date"), F.col("id").cast("int")).alias("price_date"),
        F.concat(F.lit("S"), "id").alias("symbol"),
        *[F.lit(1).cast(S.PRICE).alias(c) for c in S.PRICE_COLUMNS],
        F.lit(1).cast("bigint").alias("volume"),
        F.current_timestamp().alias("_ingestion_timestamp"),
        F.lit("x").alias("_data_source"),
        F.current_date().alias("_processing_date"),
    )
    old = batch.withColumn("price_date", F.add_months("price_date", -24))
    append_silver(batch.unionByName(old), schema)
    used = []
    plan = insert_or_ignore(stored_years(batch, schema), batch, S.SILVER_KEY, ["volume"], used)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "Sort " not in text
    assert {f.split("price_year=")[1][:4] for f in stored_years(batch, schema).inputFiles()} == {"2019"}
    assert plan.count() == 0 and len(used) == 1
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert insert_or_ignore(stored_years(batch, schema), batch, S.SILVER_KEY, ["volume"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_silver_defaults_and_keys(spark, schema):
    row = {"symbol": "A", "price_date": "2019-03-15"}
    columns = [F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in S.SILVER_SCHEMA]
    rows = spark.range(1).select(*columns)
    append_silver(rows, schema)
    stored = read_table(spark, schema, SILVER).first()
    assert stored["_data_source"] == "alpha_vantage" and stored["_processing_date"] is not None
    with pytest.raises(Exception, match="symbol is null"):
        append_silver(rows.withColumn("symbol", F.lit(None).cast("string")), schema)


def test_long_texts_stop_the_write(spark, schema):
    row = {"symbol": "A" * 11, "price_date": "2019-03-15"}
    rows = spark.range(1).select(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in S.SILVER_SCHEMA])
    with pytest.raises(Exception, match="symbol is longer than 10"):
        append_silver(rows, schema)


def test_small_files_are_compacted(spark, schema):
    for i in range(3):
        bronze_to_silver(frame(spark, (f"S{i}", payload({"2019-03-15": GOOD, "2018-03-16": GOOD}))), schema, NOW).release()
    before = silver(spark, schema)
    assert compact_silver(spark, schema, max_files=2) == [2018, 2019]
    assert silver(spark, schema) == before
    assert len(read_table(spark, schema, SILVER).inputFiles()) == 2 and compact_silver(spark, schema, max_files=2) == []


def test_rejected_payloads_are_kept_once(spark, schema):
    batch = frame(spark, ("A", payload({"2019-03-15": GOOD})), ("B", "{bad"), ("C", json.dumps({SERIES: None})))
    for _ in range(2):
        load = bronze_to_silver(batch, schema, NOW)
    kept = {r["symbol"]: (r["reject_reason"], r["payload"], r["file_path"]) for r in read_table(spark, schema, QUARANTINE).collect()}
    assert kept == {"B": ("unreadable", "{bad", "file-001"), "C": ("malformed_series", json.dumps({SERIES: None}), "file-002")}
    assert read_table(spark, schema, QUARANTINE).count() == 2
    load.release()
    with pytest.raises(PayloadsRejected):
        bronze_to_silver(frame(spark, ("D", "{bad")), schema, NOW, raise_on_reject=True)
    assert set(silver(spark, schema)) == {("A", "2019-03-15")}
    assert {r["symbol"] for r in read_table(spark, schema, QUARANTINE).collect()} == {"B", "C", "D"}


def test_the_source_is_judged_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)
    rows = [("A", payload({"2019-03-15": GOOD})), ("B", "{bad"), ("C", payload({"2019-03-15": without("6. volume")}))]

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = frame(spark, *rows).mapInArrow(count, frame(spark, *rows).schema)
    landing = land_payloads(source, folder, NOW)
    assert landing.failed.count() == landing.invalid.count() == 1
    assert [tuple(r) for r in landing.written.collect()] == [("A", "symbol=A/date=2025-12-01/run=093000")]
    assert seen.value == 3


def test_a_landing_in_several_files_is_complete(spark, folder):
    rows = [("HOT", payload({"2019-03-15": {**GOOD, "6. volume": str(i)}})) for i in range(400)]
    many = frame(spark, *rows, ("S1", rows[0][1])).repartition(8)
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        write_bronze(frame(spark, ("HOT", rows[0][1])), folder, NOW)
        write_bronze(many, folder, "2025-12-01 10:00:00")
    finally:
        for k in sizes:
            spark.conf.unset(k)
    latest = latest_bronze(spark, folder)
    assert latest.filter("symbol = 'HOT'").select("file_path").distinct().count() > 1
    assert {r["symbol"]: r["count"] for r in latest.groupBy("symbol").count().collect()} == {"HOT": 400, "S1": 1}
    assert {r["run"] for r in latest.collect()} == {"100000"}


def test_blank_files_are_rejected(spark, schema, folder):
    path = f"{folder}/symbol=A/date=2025-12-01/run=093000"
    spark.createDataFrame([(" ",)], "value string").coalesce(1).write.text(path)
    assert read_bronze(spark, folder).count() == 0
    load = bronze_to_silver(read_bronze(spark, folder, whole_files=True), schema, NOW)
    assert [r["reject_reason"] for r in load.rejected.collect()] == ["unreadable"]


def test_audit_failure_is_only_logged(spark):
    metrics = spark.createDataFrame([("A", 3, 2)], "symbol string, rows_processed bigint, rows_loaded bigint")
    assert append_audit(metrics, "no_such_schema") is False


def test_audit_defaults(spark, schema):
    assert append_audit(spark.range(1), schema)
    row = read_table(spark, schema, AUDIT).first()
    assert (row["stock_symbol"], row["rows_processed"], row["rows_rejected"], row["duration_seconds"]) == ("N/A", 0, 0, 0.0)
    assert row["run_timestamp"] is not None and len(row["audit_id"]) == 36


def test_landing_and_numeric_tickers(spark, folder):
    rows = [
        ("600519", payload({"2019-03-15": GOOD})),
        ("IBM", json.dumps({SERIES: {"2019-03-15": GOOD}}, indent=1)),
        ("LIM", json.dumps({"Note": "API call frequency"})),
        ("BAD", payload({"2019-03-15": without("6. volume")})),
    ]
    landing = land_payloads(frame(spark, *rows), folder, NOW)
    assert [r["symbol"] for r in landing.failed.collect()] == ["LIM"]
    assert [r["failed_check"] for r in landing.invalid.collect()] == ["missing_field"]
    back = read_bronze(spark, folder)
    assert {(r["symbol"], str(r["date"])) for r in back.collect()} == {("600519", "2025-12-01"), ("IBM", "2025-12-01")}
    assert all(json.loads(r["payload"])[SERIES]["2019-03-15"] == GOOD for r in back.collect())


def test_printed_documents_are_read_per_file(spark, folder):
    text = json.dumps({SERIES: {"2019-03-15": GOOD}}, indent=2)
    path = f"{folder}/symbol=A/date=2025-12-01/run=093000"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    assert [r["payload"].strip() for r in read_bronze(spark, folder, whole_files=True).collect()] == [text]


def test_latest_file_per_symbol(spark, folder):
    both = ("A", "B+#1 x")
    write_bronze(frame(spark, *[(name, payload({"2019-03-08": GOOD})) for name in both]), folder, NOW)
    write_bronze(frame(spark, ("A", payload({"2019-03-15": GOOD}))), folder, "2025-12-08 09:30:00")
    latest = latest_bronze(spark, folder)
    got = {r["symbol"]: (str(r["date"]), "2019-03-15" in r["payload"]) for r in latest.collect()}
    assert got == {"A": ("2025-12-08", True), "B+#1 x": ("2025-12-01", False)}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert [r["symbol"] for r in latest_bronze(spark, folder, symbol="A").collect()] == ["A"]
    with pytest.raises(ValueError, match="no payload files for C"):
        latest_bronze(spark, folder, symbol="C")


def test_stream_picks_up_each_file_once(spark, schema, folder):
    checkpoint, seen = scratch_path(spark, "pickup"), []

    def run():
        pick_up(
            spark, folder, schema, checkpoint, NOW,
            on_batch=lambda load: seen.append({r["symbol"]: r["rows_processed"] for r in load.counts.collect()}),
        )

    write_bronze(frame(spark, ("A", payload({"2019-03-15": GOOD})), ("B", payload({"2019-03-15": GOOD}))), folder, NOW)
    run()
    write_bronze(frame(spark, ("A", payload({"2019-03-15": GOOD, "2019-03-22": GOOD}))), folder, NOW)
    run()
    run()
    assert seen == [{"A": 1, "B": 1}, {"A": 2}]
    assert set(silver(spark, schema)) == {("A", "2019-03-15"), ("A", "2019-03-22"), ("B", "2019-03-15")}


def test_many_symbols_share_the_files_that_the_stream_picks_up(spark, schema, folder):
    checkpoint, seen = scratch_path(spark, "pickup"), []

    def run():
        pick_up(spark, folder, schema, checkpoint, NOW, packed=True, on_batch=lambda load: seen.append(load.totals["rows_processed"]))

    rows = [(f"S{i}", payload({"2019-03-15": GOOD})) for i in range(300)]
    write_packed(frame(spark, *rows, ("BAD", "{bad\r\ntext"), ("600519", " "), (None, rows[0][1])), folder, NOW)
    back = read_bronze(spark, folder, packed=True)
    assert back.select("file_path").distinct().count() <= 8
    texts = {r["symbol"]: r["payload"] for r in back.collect()}
    assert len(texts) == 302 and texts["BAD"] == "{bad text" and texts[None] == rows[0][1]
    run()
    run()
    assert seen == [300]
    assert {(r["symbol"], r["reject_reason"]) for r in read_table(spark, schema, QUARANTINE).collect()} == {("BAD", "unreadable"), (None, "symbol")}
    assert len(silver(spark, schema)) == 300


def test_a_repeated_packed_landing_is_there_once(spark, folder):
    one, two = payload({"2019-03-15": GOOD}), payload({"2019-03-22": GOOD})
    write_packed(frame(spark, ("A", one)), folder, "2025-11-24 09:30:00")
    for part in ([("A", one), (None, one)], [("A", one), ("B", one), ("B", two)], [("A", two), (None, two)]):
        write_packed(frame(spark, *part), folder, NOW)
    got = sorted((str(r["date"]), r["symbol"] or "", "03-22" in r["payload"]) for r in read_bronze(spark, folder, packed=True).collect())
    new = "2025-12-01"
    assert got == [("2025-11-24", "A", False), (new, "", True), (new, "A", True), (new, "B", False), (new, "B", True)]


def test_refresh_builds_gold_in_the_catalog(spark, schema, folder):
    write_bronze(frame(spark, ("ibm", payload({"2019-03-15": GOOD})), ("ZZZ", payload({"2019-03-15": GOOD}))), folder, NOW)
    gold = refresh(spark, folder, schema, default_seed(spark), scratch_path(spark, "pickup"), NOW)
    assert spark.table(f"{schema}.fact_adjusted_prices").count() == 2
    assert check_gold(gold, raise_errors=True).filter("n_violations > 0").count() == 0
    again = build_gold(read_table(spark, schema, SILVER), default_seed(spark), schema)
    assert again.fact.count() == 2


def test_csv_scans(spark, folder):
    spark.createDataFrame([("symbol,company_name,sector,industry",), ("A,Ä—B,S,I",)], "v string").coalesce(1).write.text(folder)
    assert tuple(read_seed(spark, folder).first()) == ("A", "Ä—B", "S", "I")
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("a,b",), ("1,2",), ("x,3",)], "v string").coalesce(1).write.text(path)
    ints = read_seed(spark, folder).schema.__class__.fromDDL("a int, b int")
    assert sorted(read_csv(spark, path, ints).collect(), key=str) == [(1, 2), (None, 3)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        read_csv(spark, path, ints, tolerant=False).collect()


def test_scratch_is_under_the_checkpoint_folder(spark):
    written = materialise(spark.range(3), "check")
    assert written.count() == 3
    assert spark.conf.get("spark.checkpoint.dir") in written.inputFiles()[0]


@pytest.mark.parametrize(("master", "allowed"), [("local[4]", True), ("yarn", False)])
def test_scratch_without_a_shared_folder(master, allowed):
    class Bare:
        conf = {}
        sparkContext = type("Context", (), {"master": master, "applicationId": "app"})

    if allowed:
        assert "/candlewick/app/x-" in scratch_path(Bare, "x")
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_path(Bare, "x")
