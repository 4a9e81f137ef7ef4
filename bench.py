"""Times the headline queries over the tables at $BENCH_SF_DIR and prints one JSON line.

Each query runs once to warm up the JVM and then BENCH_RUNS times; the least time counts.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from gleanset.plans.catalog import all_queries

HEADLINE = (
    "global_search",
    "ordered_dedup",
    "ordered_dedup_actions",
    "find_matches",
    "find_matches_pages",
    "any_and_any",
    "multi_scan",
    "clean_project",
    "coverage_report",
    "provenance",
    "run_result",
    "sliding_runs",
    "csv_append",
    "incremental_append",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = all_queries()
    times, failed = {}, {}
    for name in HEADLINE:
        best = None
        try:
            for turn in range(runs + 1):
                begun = time.perf_counter()
                catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                spent = time.perf_counter() - begun
                if turn > 0:
                    best = spent if best is None else min(best, spent)
        except Exception as error:  # one query's failure leaves the others' times
            failed[name] = str(error)[:200]
            continue
        times[name] = round(best, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": int(cpus),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))


if __name__ == "__main__":
    main()
