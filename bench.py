"""Seconds per named query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times; the median counts.  Every result is
written to Spark's no-op sink, so all rows and columns are computed and none reach the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwatch.plans.catalogue import queries  # noqa: E402
from tillwatch.session import spark_session  # noqa: E402

HEADLINE = [
    "stg_transactions", "parse_json_events", "insert_if_absent", "int_merchant_revenue",
    "int_user_daily_summary", "mart_revenue_daily", "mart_fraud_report", "revenue_by_merchant",
    "revenue_by_country", "revenue_daily_recent", "velocity_windows", "velocity_score",
    "amount_windows", "amount_spike", "geo_pairs", "geo_anomaly", "fraud_score", "alerts",
    "top_flagged_users", "recent_alerts", "fraud_trend_hourly", "fraud_heatmap",
    "circuit_breaker_rate", "alert_stats", "dq_not_null", "dq_unique", "schema_diff",
    "latest_freshness", "data_debt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = spark_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
