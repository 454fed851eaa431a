"""Loads that are repeated, models that are refreshed and published, and what the stored layout prunes."""

import uuid

import pytest
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.operators import parse
from candlewick.operators.payload import READABLE
from candlewick.operators import checks as Q
from candlewick.operators.ranking import insert_or_ignore
from candlewick.operators.stats import merged_moments, moments, with_zscore
from candlewick.plans import bronze_to_silver, build_gold, gold_mart, select_rows
from candlewick.plans import gold as G
from candlewick.plans import views as V
from candlewick.plans.contracts import SILVER_CONTRACTS
from candlewick.plans.gold import check_layers, read_gold, refresh_gold
from candlewick.plans.load import TOTALS
from candlewick.plans.mart import chart_series, stored_zscores
from candlewick.sources import latest_bronze, read_bronze, read_table
from candlewick.sources.bronze import write_bronze
from candlewick.sources.scratch import materialise, scratch_path
from candlewick.sources.tables import (
    QUARANTINE,
    SILVER,
    VERSION,
    append_changes,
    append_silver,
    build_version,
    compact_silver,
    pending_changes,
    publish,
    setup_tables,
    stored_digests,
    stored_years,
)
from candlewick.streaming import refresh, track_newest, tracked_newest

from helpers import GOOD, frame, payload

NOW = "2025-12-01 09:30:00"
SF = "/root/testdata/sf0.001"
TIMES = ("dbt_load_timestamp", "created_at", "load_timestamp")


def rows_of(df):
    return sorted(map(str, df.drop(*TIMES, *S.GOLD_PARTS).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- landing and loading ---------------------------------------------------------------


def test_a_repeated_landing_is_there_once(spark, folder):
    rows = frame(spark, ("A", payload({"2019-03-15": GOOD})), ("B", payload({"2019-03-15": GOOD})), ("B", payload({"2019-03-22": GOOD})))
    other = frame(spark, ("A", payload({"2018-03-16": GOOD})))
    write_bronze(other, folder, "2025-11-24 09:30:00")
    for _ in range(3):
        write_bronze(rows, folder, NOW)
    counts = {r["symbol"]: r["count"] for r in read_bronze(spark, folder).groupBy("symbol").count().collect()}
    assert counts == {"A": 2, "B": 2}
    assert latest_bronze(spark, folder, symbol="B").count() == 2


def test_a_landing_that_dies_half_way_can_be_repeated(spark, folder):
    rows = frame(spark, *[(f"S{i}", payload({"2019-03-15": GOOD})) for i in range(12)]).repartition(4)
    broken = rows.withColumn("payload", F.when(F.col("symbol") == "S7", F.raise_error(F.lit("lost"))).otherwise(F.col("payload")))
    write_bronze(rows.filter("symbol < 'S3'"), folder, NOW)
    with pytest.raises(Exception, match="lost"):
        write_bronze(broken, folder, NOW)
    write_bronze(rows, folder, NOW)
    assert {r["count"] for r in read_bronze(spark, folder).groupBy("symbol").count().collect()} == {1}
    assert read_bronze(spark, folder).count() == 12


def test_only_whole_documents_are_read(spark):
    good = payload({"2019-03-15": GOOD})
    texts = [good, f" {good} ", "[1, 2]", "7", "{}", good[:-1] + ',"x":"] y"}', good[:-1] + ',"x":[1]}']
    tails = ["] x", "],[1", "} ]", "] [", " x", ",", "}", "]", f",{good}", good, '],"y":[']
    got = parse(frame(spark, *[("A", t) for t in texts + [good + t for t in tails]])).select("payload", READABLE).collect()
    assert [r["payload"] for r in got if r[READABLE]] == texts


def test_compaction_leaves_the_other_years(spark, schema):
    for i in range(3):
        bronze_to_silver(frame(spark, (f"S{i}", payload({"2019-03-15": GOOD}))), schema, NOW).release()
    bronze_to_silver(frame(spark, ("A", payload({"2018-03-16": GOOD, "2017-03-17": GOOD}))), schema, NOW).release()
    before = rows_of(read_table(spark, schema, SILVER))
    assert compact_silver(spark, schema, max_files=2) == [2019]
    assert rows_of(read_table(spark, schema, SILVER)) == before and len(before) == 5
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_quarantine_reads_the_digests_of_the_batch_days_only(spark, schema):
    bad = frame(spark, ("B", "{bad"), ("C", "{worse"))
    for days in (0, 400, 400):
        at = F.date_add(F.to_date("loaded_at"), days).cast("timestamp")
        bronze_to_silver(bad.withColumn("loaded_at", at), schema, NOW).release()
    nowhere = bad.withColumn("loaded_at", F.lit(None).cast("timestamp"))
    for _ in range(2):
        bronze_to_silver(nowhere, schema, NOW).release()
    assert read_table(spark, schema, QUARANTINE).count() == 6
    days = [r[0] for r in read_table(spark, schema, QUARANTINE).filter("landed_on > '1970-06-01'").select("landed_on").distinct().collect()]
    stored = stored_digests(spark, schema, days)
    assert "ReadSchema: struct<digest:string>" in plan(stored) and "PartitionFilters: [isnotnull(landed_on" in plan(stored)
    assert stored.count() == 2 and len(stored.inputFiles()) > 0


# --- gold --------------------------------------------------------------------------------


def loaded(spark, schema, rows):
    append_rows = rows.withColumn("_processing_date", F.lit("2002-01-01").cast("date"))
    append_changes(append_rows, schema)
    append_silver(append_rows, schema)


@pytest.fixture(scope="module")
def prices(spark):
    return materialise(V.silver(spark, SF), "prices")


def parts_of(prices):
    early, late_symbol = F.col("price_date") < "1996-01-01", F.col("symbol").endswith(".pr")
    return [prices.filter(early & ~late_symbol), prices.filter(~early & ~late_symbol), prices.filter(late_symbol)]


def same_as_full_build(spark, schema, gold, seed):
    silver = read_table(spark, schema, SILVER)
    full = build_gold(silver, seed, sector_groups=V.TYPE_GROUPS)
    for name, df in full.tables().items():
        assert rows_of(gold.tables()[name]) == rows_of(df), name
    z = {(r["symbol"], r["date"]): r["z_score"] for r in stored_zscores(gold).collect()}
    plain = with_zscore(gold_mart(full), "symbol", "adjusted_close_price").collect()
    assert len(z) == len(plain) > 0
    for r in plain:
        mine = z[r["symbol"], r["date"]]
        assert mine == r["z_score"] or abs(mine - r["z_score"]) < 1e-9


def test_refreshed_models_equal_a_full_build(spark, schema, prices, monkeypatch):
    seed = V.seed(spark, SF)
    first, second, third = parts_of(prices)
    loaded(spark, schema, first)
    refresh_gold(spark, schema, seed, V.TYPE_GROUPS)
    files = set(read_gold(spark, schema).fact.inputFiles())
    loaded(spark, schema, second)
    gold = refresh_gold(spark, schema, seed, V.TYPE_GROUPS)
    # Years that the load did not touch keep their files.
    assert len(files & set(gold.fact.inputFiles())) > 0 and pending_changes(spark, schema).isEmpty()
    loaded(spark, schema, third)

    def dies(*_, **__):
        raise RuntimeError("lost")

    # A refresh that dies between its tables is finished by the next one.
    with monkeypatch.context() as m:
        m.setattr(G, "build_moments", dies)
        with pytest.raises(RuntimeError):
            refresh_gold(spark, schema, seed, V.TYPE_GROUPS)
    assert not pending_changes(spark, schema).isEmpty()
    gold = refresh_gold(spark, schema, seed, V.TYPE_GROUPS)
    same_as_full_build(spark, schema, gold, seed)
    assert refresh_gold(spark, schema, seed, V.TYPE_GROUPS).fact.count() == gold.fact.count()
    assert check_layers(spark, schema, raise_errors=False).filter("table_name = 'weekly_adjusted_prices'").count() > 0


def test_a_load_that_died_before_its_rows_were_stored_is_harmless(spark, schema, prices):
    seed = V.seed(spark, SF)
    loaded(spark, schema, prices.filter("price_date < '1996-01-01'"))
    refresh_gold(spark, schema, seed, V.TYPE_GROUPS)
    append_changes(prices.filter("price_date >= '1997-01-01'"), schema)
    gold = refresh_gold(spark, schema, seed, V.TYPE_GROUPS)
    same_as_full_build(spark, schema, gold, seed)


def test_the_stream_refreshes_and_checks(spark, schema, folder):
    seed = spark.createDataFrame([], S.SEED_SCHEMA)
    for day in ("2019-03-15", "2020-03-13"):
        write_bronze(frame(spark, ("A", payload({day: GOOD})), ("B", payload({day: GOOD}))), folder, f"{day} 10:00:00")
        gold = refresh(spark, folder, schema, seed, scratch_path(spark, "c"), NOW, check=True)
    assert gold.fact.count() == 4 and gold.dim_stock.count() == 2 and gold.dim_date.count() == 2


def test_a_failed_build_leaves_the_published_one(spark, schema):
    one = spark.range(3).withColumn("p", F.lit(1))
    publish(spark, schema, {"m": build_version(one, schema, "m", ["p"])})
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id"), F.lit(1).alias("p"))
    with pytest.raises(Exception, match="lost"):
        build_version(bad, schema, "m", ["p"])
    assert spark.table(f"{schema}.m").count() == 3
    held = spark.table(f"{schema}.m")
    for n in (4, 5, 6):
        publish(spark, schema, {"m": build_version(spark.range(n).withColumn("p", F.lit(1)), schema, "m", ["p"])})
        if n == 4:
            # Who still reads the build before is not disturbed.
            assert held.count() == 3
    assert spark.table(f"{schema}.m").count() == 6
    assert len([t for t in spark.catalog.listTables(schema) if VERSION in t.name]) == 2


def test_questions_prune_the_stored_fact(spark, schema, prices):
    gold = build_gold(prices, V.seed(spark, SF), schema, V.TYPE_GROUPS)
    mart = gold_mart(gold)
    narrow = select_rows(mart, ["Financial Services"], since="1995-01-01", until="1995-12-31")
    text = plan(narrow)
    assert text.count("SubqueryAdaptiveBroadcast dynamicpruning") == 2
    year = select_rows(mart, since="1995-01-01", until="1995-12-31")

    def files_read(df):
        """Fact files that a finished scan has opened, from its metrics."""
        df.collect()
        found, todo = [], [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            name = node.getClass().getSimpleName()
            if name == "AdaptiveSparkPlanExec":
                todo.append(node.finalPhysicalPlan())
            elif name.endswith("QueryStageExec"):
                todo.append(node.plan())
            else:
                if name == "FileSourceScanExec" and "volatility_pct" in node.simpleString(1000):
                    found.append(node.metrics().apply("numFiles").value())
                todo += [node.children().apply(i) for i in range(node.children().size())]
        return sum(found)

    whole = files_read(gold_mart(gold))
    assert 0 < files_read(year) < whole
    assert year.count() == mart.filter("year(date) = 1995").count() > 0


# --- figures -----------------------------------------------------------------------------


def test_merged_moments_are_those_of_the_whole(spark):
    rows = spark.range(5000).select(
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("k"), (F.col("id") % 13).alias("part"), (1e9 + F.rand(5)).alias("v")
    )
    rows = materialise(rows.unionByName(spark.createDataFrame([("lone", 1, 4.0), ("none", 1, None)], "k string, part bigint, v double")), "values")
    whole = {r["k"]: r for r in moments(rows, ["k"], "v").collect()}
    merged = {r["k"]: r for r in merged_moments(moments(rows, ["k", "part"], "v"), "k").collect()}
    assert set(merged) == set(whole) - {"none"}
    for k, r in merged.items():
        assert r["n"] == whole[k]["n"] and abs(r["mean"] - whole[k]["mean"]) < 1e-6 and abs(r["m2"] - whole[k]["m2"]) < 1e-4


def test_thinned_lines_keep_their_extremes(spark):
    rows = spark.range(1000).select(
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("A").alias("symbol"),
        ((F.col("id") * 7919) % 311).cast("decimal(15,4)").alias("adjusted_close_price"),
    )
    rows = rows.unionByName(spark.createDataFrame([("2000-02-01", "B", 5)], "date string, symbol string, p int").select(F.to_date("date").alias("date"), "symbol", F.col("p").cast("decimal(15,4)").alias("adjusted_close_price")))
    got = chart_series(rows, 20)
    per_bin = got.filter("symbol = 'A'").groupBy("bin").count().collect()
    assert len(per_bin) == 20 and max(r["count"] for r in per_bin) <= 4
    ends = got.filter("symbol = 'A'").agg(F.min("date"), F.max("date"), F.min("adjusted_close_price"), F.max("adjusted_close_price")).first()
    assert tuple(map(str, ends)) == ("2000-01-01", "2002-09-26", "0.0000", "310.0000")
    assert got.filter("symbol = 'B'").count() == 1 and chart_series(rows.limit(0), 20).count() == 0


def test_newest_landing_survives_a_restart(spark, folder):
    checkpoint, out = scratch_path(spark, "newest"), scratch_path(spark, "table")
    rows = frame(spark, ("A", payload({"2019-03-15": GOOD})), ("B+/1", payload({"2019-03-15": GOOD})))
    for part, at in ((rows, "2025-12-01 09:30:00"), (rows.filter("symbol = 'A'"), "2025-12-08 09:30:00"), (rows, "2025-11-24 09:30:00")):
        write_bronze(part, folder, at)
        track_newest(spark, folder, checkpoint, out)
    got = {r["symbol"]: (r["date"], r["run"]) for r in tracked_newest(spark, out).collect()}
    latest = {r["symbol"]: (str(r["date"]), r["run"]) for r in latest_bronze(spark, folder).select("symbol", "date", "run").distinct().collect()}
    assert got == latest == {"A": ("2025-12-08", "093000"), "B+/1": ("2025-12-01", "093000")}


# --- measured writes, keys that stay where they are ----------------------------------------


def test_a_load_is_measured_by_its_own_writes(spark, schema):
    broken = {**GOOD, "5. adjusted close": "NaN"}
    rows = frame(
        spark,
        ("A", payload({"2019-03-15": GOOD, "2019-03-22": {**GOOD, "6. volume": "-1"}, "2020-03-20": broken})),
        ("B", "no document"),
        ("C", payload({})),
    )
    load = bronze_to_silver(rows, schema, NOW)
    assert load.totals == {"rows_processed": 3, "rows_loaded": 2, "n_rejected": 1, "rows_new": 2}
    counted = load.counts.groupBy().sum("rows_processed", "rows_loaded", "rows_new").first()
    assert tuple(counted) == (3, 2, 2)
    stored = Q.run_checks({SILVER: read_table(spark, schema, SILVER)}, [c for c in SILVER_CONTRACTS if c.kind not in Q.KEY_KINDS])
    assert rows_of(load.report) == rows_of(stored)
    assert {r["column_name"] for r in load.report.filter("n_violations > 0").collect()} == {"adjusted_close"}
    again = bronze_to_silver(rows, schema, NOW)
    assert again.totals["rows_new"] == 0 and again.report.filter("n_violations > 0").isEmpty()
    assert read_table(spark, schema, QUARANTINE).count() == 1


def test_a_checked_load_stops_before_silver(spark, schema):
    rows = frame(spark, ("A", payload({"2019-03-15": {**GOOD, "5. adjusted close": "inf"}})))
    with pytest.raises(Q.ContractViolation):
        bronze_to_silver(rows, schema, NOW, check=True)
    assert read_table(spark, schema, SILVER).isEmpty() and pending_changes(spark, schema).isEmpty()
    assert bronze_to_silver(frame(spark), schema, NOW, check=True).totals == dict.fromkeys(TOTALS, 0)


def test_stored_keys_of_a_bucketed_table_stay_where_they_are(spark):
    schema = f"t_{uuid.uuid4().hex}"
    setup_tables(spark, schema, scratch_path(spark, schema), buckets=8)
    bronze_to_silver(frame(spark, ("A", payload({"2019-03-15": GOOD, "2020-03-20": GOOD}))), schema, NOW)
    late = frame(spark, ("A", payload({"2019-03-15": GOOD, "2019-03-22": GOOD})), ("B", payload({"2019-03-15": GOOD})))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        silver = read_table(spark, schema, SILVER)
        batch = materialise(silver.limit(1), "batch")
        hits = Q.stored_hits(stored_years(batch, schema), batch, S.SILVER_KEY)
        assert plan(hits).count("Exchange") == 1 and "Bucketed: true" in plan(hits)
        assert hits.count() == 1
        groups = silver.groupBy(*S.SILVER_KEY).count()
        assert "Exchange" not in plan(groups)
        assert bronze_to_silver(late, schema, NOW).totals["rows_new"] == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert bronze_to_silver(late, schema, NOW).totals["rows_new"] == 0
    keys = sorted((str(r[0]), r[1]) for r in read_table(spark, schema, SILVER).select(*S.SILVER_KEY).collect())
    assert keys == [("2019-03-15", "A"), ("2019-03-15", "B"), ("2019-03-22", "A"), ("2020-03-20", "A")]
    compact_silver(spark, schema, max_files=0)
    assert read_table(spark, schema, SILVER).groupBy(*S.SILVER_KEY).count().filter("count = 1").count() == 4


def test_a_load_is_judged_by_its_own_keys(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "a")], "k int, s string")
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "c"), (None, "z")], "k int, s string")
    parents = {"p": spark.createDataFrame([("a",), ("b",)], "name string")}
    checks = [Q.unique_combination("t", "k", "s"), Q.unique("t", "k"), Q.relationship("t", "s", "p", "name").warn()]
    report = Q.load_checks(stored, batch, parents, checks)
    assert {r["column_name"]: r["n_violations"] for r in report.collect()} == {"k,s": 2, "k": 3, "s": 3}
    clean = Q.load_checks(stored, batch.filter("k = 9"), parents, checks)
    assert clean.filter("n_violations > 0").isEmpty() and clean.count() == 3
    with pytest.raises(ValueError):
        Q.load_checks(stored, batch, parents, Q.not_null("t", "k"))
