"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the number of local threads. Each query runs once to warm up and is then
timed twice, from building the DataFrame to producing its last row; the
fastest counts.
"""

from __future__ import annotations

import json
import os
import time

from checks.compare import session
from checks.queries import QUERIES

HEADLINE = (
    "stg_transactions",
    "json_decode",
    "spending_profile",
    "geography_profile",
    "timing_profile",
    "velocity_profile",
    "device_profile",
    "customer_baseline",
    "burst_counts",
    "previous_transaction",
    "mart_fraud_detection",
    "risk_level_summary",
    "detection_metrics",
    "alert_route",
)
# several runs over stored tables each: timed once
LONG = ("stream_ingest", "baseline_incremental", "mart_incremental", "run_cycle", "stream_score")


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    taken = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        taken[name] = round(min(seconds(spark, name, sf_dir) for _ in range(2)), 3)
    for name in LONG:
        taken[name] = round(seconds(spark, name, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
