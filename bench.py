"""Time the headline queries: warm, best of three, whole result computed by a no-op sink.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Prints one JSON line. ``exchanges`` counts the shuffles of each query's last plan.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.registry import QUERIES, Run, comparable

HEADLINE = (
    "ingest_card_fixed_a",
    "ingest_va_auto",
    "ingest_dispatch",
    "map_upload",
    "reason_by_text",
    "va_drop_paid",
    "allocate_approved",
    "allocate_rejected",
    "close_bills",
    "ledger_rejected",
    "hold_rejected",
    "email_recurring",
    "post_approved",
)
ROUNDS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, exchanges = {}, {}
    for name in names:
        best = float("inf")
        for _ in range(ROUNDS):
            start = time.perf_counter()
            found = comparable(QUERIES[name](Run(spark, sf_dir)))
            found.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
        exchanges[name] = found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    print(
        json.dumps(
            {
                "metric": "reconciliation_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "exchanges": exchanges,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
