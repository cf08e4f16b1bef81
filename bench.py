"""Time every registered query and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 3,
after one warm-up; streaming queries run once, after one warm-up). Results go to the
``noop`` sink, so every row is computed and none passes through the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from tidemark.plans.catalog import QUERIES
from tidemark.session import local_session


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = local_session(
        cpus, cpus, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-bench-")}
    )
    times: dict[str, float] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        seconds(query, spark, sf_dir)
        repeat = 1 if name.startswith("stream_") else runs
        times[name] = round(statistics.median(seconds(query, spark, sf_dir) for _ in range(repeat)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rates = {
        name: round(events / times[name])
        for name in ("stream_tumbling_count", "stream_refund_alarm")
        if name in times
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of query times, median of runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "events_per_sec": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
