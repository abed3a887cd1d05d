"""Time the headline queries: full results, computed and discarded. Prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Each query runs
twice: the total is of the second runs, the first ones, which also plan and compile, are listed beside them.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from verification.registry import load_all, run

HEADLINES = [
    "fct_invoices",
    "fct_payments",
    "fct_usage_events",
    "dim_subscriptions",
    "customer_usage_stats",
    "customer_support_signals",
    "customer_financial_signals",
    "customer_health_score",
    "mart_mrr",
    "mart_nrr",
    "mart_support_summary",
    "apply_corrections",
    "merge_dimension",
    "run_expectations",
    "engagement_quadrant",
    "dq_flags",
    "load_batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    first, seconds = {}, {}
    for name in HEADLINES:
        for taken in (first, seconds):
            began = time.perf_counter()
            run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, second run, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
