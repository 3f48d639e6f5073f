"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 3, after one
warm-up; the median counts). Results go to a sink that computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "agg_median_mean",
    "agg_daily",
    "agg_raw_60s",
    "asof_backward",
    "resample_forward",
    "resample_by_day",
    "clean_documented",
    "clean_wide",
    "canonical_long",
    "kv_parse",
    "kv_lenient_long",
    "dedup_subset",
    "prune_overlap",
    "replace_range",
    "load_missing_days",
]


def main() -> None:
    from sensorpipe.plans.queries import names

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = names(), {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, warm median", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
