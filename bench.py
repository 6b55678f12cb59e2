"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Results go to the
noop sink, so whole results are computed and nothing passes through the driver.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parse_states", "silver_table", "silver_dedup", "flight_features", "flight_features_sliced",
    "congestion_features", "congestion_join", "route_features",
    "dq_bronze", "dq_null_ratio", "materialize_all", "asof_join", "delay_labels",
    "nearest_congestion", "hash_sample", "split_stratified", "standardize", "metric_auc",
    "metric_regression", "drift_psi", "gate", "lof", "anomaly_scores", "delay_scores",
    "stream_congestion", "stream_tracks", "stream_merge_batches", "silver_write_readback",
    "flight_features_range", "congestion_job_range", "materialize_upsert",
]
RUNS = 3


def main():
    from pyspark.sql import SparkSession

    from skyloom.plans.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skyloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
