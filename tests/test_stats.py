from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.operators import grouped_quantiles, share_of_total, with_zscore
from candlewick.plans import anomaly_count


def test_zscore_edge_groups(spark):
    rows = [("one", 5.0), ("flat", 2.0), ("flat", 2.0), (None, 1.0), (None, 3.0), ("gap", None), ("gap", 1.0)]
    got = with_zscore(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()
    assert len(got) == len(rows)
    scores = {(r["k"], r["v"]): r["z_score"] for r in got}
    assert scores["one", 5.0] is None and scores["flat", 2.0] is None and scores["gap", 1.0] is None
    assert scores[None, 3.0] == pytest.approx(2**-0.5)


def test_one_outlier(spark):
    df = spark.createDataFrame([("a", 1.0)] * 10 + [("a", 100.0)] + [("b", 1.0)] * 3, "symbol string, p double")
    got = {r["symbol"]: (r["n_rows"], r["anomalies"]) for r in anomaly_count(df, "symbol", "p").collect()}
    assert got == {"a": (11, 1), "b": (3, 0)}


def test_zscore_of_a_hot_key_needs_no_window(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("k"), (F.col("id") % 97).cast("double").alias("v")
    )
    scored = with_zscore(df, "k", "v")
    assert "Window" not in scored._jdf.queryExecution().executedPlan().toString()
    pdf = scored.filter("k = 0").toPandas()
    want = (pdf.v - pdf.v.mean()) / pdf.v.std(ddof=1)
    assert np.allclose(pdf.z_score, want)


def test_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 4)], "k string, v bigint")
    got = {r["k"]: (r["v"], r["share"]) for r in share_of_total(df, "k", "v").collect()}
    assert got == {"a": (3, 0.375), "b": (1, 0.125), None: (4, 0.5)}


@settings(max_examples=6, deadline=None)
@given(
    st.dictionaries(
        st.sampled_from(["a", "b", None]),
        st.lists(st.integers(-50000, 50000), min_size=1, max_size=60),
        min_size=1,
    ),
)
def test_quantiles_equal_linear_interpolation(spark, groups):
    rows = [(k, Decimal(v).scaleb(-4)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v decimal(18,4)")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = {r["k"]: r for r in grouped_quantiles(df, "k", "v", probs).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        x = np.array(vs) / 1e4
        row = got[k]
        assert row["n"] == len(vs) and row["min"] == pytest.approx(x.min()) and row["max"] == pytest.approx(x.max())
        mine = [row[c] for c in ("q0", "q10", "q25", "q50", "q75", "q100")]
        assert mine == pytest.approx(list(np.quantile(x, probs)))


def test_quantiles_leave_nulls_out(spark):
    df = spark.createDataFrame([("a", Decimal("1.0")), ("a", None)], "k string, v decimal(18,4)")
    assert tuple(grouped_quantiles(df, "k", "v", (0.5,)).first()) == ("a", 1, 1.0, 1.0, 1.0)
    assert grouped_quantiles(df.limit(0), "k", "v").count() == 0
    with pytest.raises(TypeError):
        grouped_quantiles(df.select("k", F.col("v").cast("double")), "k", "v")


def test_quantiles_with_one_extreme_outlier(spark):
    rows = spark.range(400).select(
        F.when(F.col("id") < 200, "a").otherwise("b").alias("k"),
        F.when(F.col("id") == 399, F.lit("9999999999999999.0000")).otherwise((F.col("id") % 200).cast("string")).cast("decimal(20,4)").alias("v"),
    )
    got = {r["k"]: (r["n"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) for r in grouped_quantiles(rows, "k", "v").collect()}
    assert got["a"] == (200, 0.0, 49.75, 99.5, 149.25, 199.0)
    assert got["b"][:5] == (200, 0.0, 49.75, 99.5, 149.25) and got["b"][5] > 9e15
