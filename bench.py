"""Seconds per headline query, the median of warm runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from riskloom.plans.catalog import REGISTRY
from riskloom.plans.registry import as_callable
from riskloom.session import local_session

HEADLINE = [
    "risk_scoring", "value_distribution", "crosstab", "cross_split_leaks", "near_duplicate_pairs", "fit_vocabulary",
    "tfidf", "score_linear", "threshold_sweep", "results_join", "column_profile", "active_subscription_asof", "running_balance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        as_callable(REGISTRY[name])(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)  # warm-up
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries, median of warm runs", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "settings": {"master": f"local[{cpus}]", "runs": runs,
                     "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}}))


if __name__ == "__main__":
    main()
