"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected); one warm-up run of the flagship is not
counted.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_stock_risk",          # typed sources -> cleaners -> fact (flagship)
    "fact_stock_risk_raw",      # dirty text sources -> cleaners -> fact
    "etl_run_fact",             # D3 end to end: clean layer written, report, fact written, run log
    "clean_orders",
    "clean_inventory",
    "quality_summary",
    "final_table_check",
    "load_orders",
    "fk_orphans",
    "region_avg_sales",
    "stratified_split",
    "classification_report",
    "csv_round_trip",
    "train_forest",
]


def main() -> None:
    from shelfrisk.registry import QUERIES
    from shelfrisk.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    QUERIES["fact_stock_risk"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
