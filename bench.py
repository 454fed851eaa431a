"""Seconds per headline query on ``$BENCH_SF_DIR``; prints one JSON line.

Every query is run in full into a sink that drops the rows.  ``BENCH_QUERIES`` picks some by name.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from candlewick.plans.registry import QUERIES
from candlewick.session import local_session

HEADLINE = [
    "stg_prices",
    "dim_date",
    "dim_stock",
    "fact_prices",
    "gold_mart",
    "sector_performance",
    "zscore",
    "zscore_events",
    "anomaly_count",
    "anomaly_count_lines",
    "kpis",
    "volume_share",
    "volume_share_lines",
    "volatility_quartiles",
    "price_quantiles_lines",
    "price_trend",
    "top3_symbols",
    "payload_flatten",
    "flatten_events",
    "payload_classify",
    "payload_validate",
    "payload_screen",
    "tolerant_cast",
    "quality_filter",
    "upsert_ignore",
    "batch_dedup",
    "latest_per_symbol",
    "audit_metrics",
    "universe_semi",
    "csv_tolerant",
    "bronze_round_trip",
    "bronze_latest",
    "audit_table",
    "upsert_new_rows",
    "silver_load",
    "stream_pick_up",
    "dq_not_null",
    "dq_unique",
    "dq_relationships",
    "dq_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    # One untimed query, so that start-up is not charged to the first.
    QUERIES["dq_not_null"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", folder)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
