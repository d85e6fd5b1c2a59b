"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of the test tables, ``BENCH_CPUS`` the cores.
Each query is run once to warm up; the median of the next three runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.cases import CASES
from tierflow.session import build_session

HEADLINES = [
    "orders_fact", "monthly_revenue", "category_performance", "customer_rfm", "report_segments",
    "report_top_customers", "bronze_shipments", "silver_shipments", "carrier_kpis",
    "active_alerts", "alerts_topk", "kpi_lookback", "stream_carrier_kpis", "indicator_flatten",
    "yoy_snapshot", "pivot_recent_years", "compact_identity", "zorder_identity",
]
RUNS = 3


def seconds(spark, name: str, sf_dir: str) -> float:
    """Time to build and fully compute a query."""
    began = time.perf_counter()
    CASES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINES:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
