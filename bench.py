"""Time the registered queries and print one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_QUERIES (names, comma
separated; default all), BENCH_RUNS (timed runs after one warm-up run, default 1; the
median counts). Results go to the noop sink, so every row is computed and none kept.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from placetime.plans.catalog import QUERIES
from placetime.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)

    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    taken = {}
    for name in names:
        once(name)
        taken[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total wall time of registered queries, after warm-up",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cores": cores,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
