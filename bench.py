"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_REPS=5 python bench.py

Each query is built and forced with a ``noop`` write (the k-center queries
also run their solver jobs while being built); the time of a query is the
median of BENCH_REPS warm runs after one warm-up. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from robustagg import catalog  # noqa: E402
from robustagg.session import build_session  # noqa: E402

HEADLINE = {
    "popularity": "product_popularity",
    "popularity_salted": "product_popularity_salted",
    "popularity_top_h": "popularity_top_h",
    "coreset": "coreset",
    "kcenter_coreset": "kcenter_coreset",
    "kcenter_objective": "kcenter_objective",
    "kcenter_exact": "kcenter_exact",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for label, name in HEADLINE.items():
        if only and label not in only:
            continue
        fn = catalog.QUERIES[name]
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[label] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_warm_medians", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
