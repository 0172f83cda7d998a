"""Headline queries, warm median of 3 runs; prints one JSON line.

BENCH_SF_DIR    folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default 8)
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import sys
import time

from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINES = (
    "history_base",
    "agency_ratios",
    "agency_features",
    "agency_score",
    "agency_profile",
    "ledger_entity_period",
    "payment_flow_and_close",
    "period_of_date",
    "contact_type",
    "period_funnel",
    "contact_funnel",
    "cohort_followup",
    "column_profile",
    "agency_history_rollup",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("agency-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # no call-site capture per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from agencylens.verification.queries import registered

    queries = {n: q for n, q in registered().items() if n in HEADLINES}

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in queries:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    total = round(sum(seconds.values()), 3)
    sf = pathlib.PurePath(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
