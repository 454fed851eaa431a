"""Every registered query against its SQL, and the shape of the plans."""

import os

import pytest

from __spark_entry__ import entry
from __spark_entry__ import oracle_sql as registered_sql
from __spark_entry__ import queries as registered
from candlewick.plans.oracle import ORACLE
from candlewick.plans.registry import QUERIES
from tools.compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = list(QUERIES)


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(NAMES) == set(oracle_sql())
    assert set(NAMES) <= set(registered()) and set(oracle_sql()) <= set(registered_sql())


def test_entry(spark):
    assert entry(spark).count() == 4


@pytest.mark.parametrize("name", NAMES)
def test_same_result_as_sql(spark, duck, name):
    rows, diff = difference(queries()[name](spark, FOLDER), duck, oracle_sql()[name])
    assert diff is None
    assert rows > 0


@pytest.mark.parametrize("name", ["fact_prices", "anomaly_count", "volatility_quartiles", "upsert_ignore"])
def test_same_result_when_nothing_is_broadcast(spark, duck, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries()[name](spark, FOLDER)
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert difference(df, duck, oracle_sql()[name])[1] is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name",
    ["fact_prices", "zscore", "kpis", "volume_share", "volatility_quartiles", "payload_validate", "upsert_ignore", "dq_relationships"],
)
def test_plans_stay_declarative(spark, name):
    text = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInArrow"):
        assert operator not in text


def test_payload_is_parsed_once(spark):
    for name in ("payload_screen", "flatten_events", "audit_metrics", "payload_validate"):
        text = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert text.count("from_json(") == 1, name


def test_scan_reads_only_what_the_view_needs(spark):
    text = queries()["stg_prices"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in text and "l_returnflag" not in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double" in text
