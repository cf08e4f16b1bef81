"""How ordered operators fare when one key holds a third of all rows.

Events repeated ``SKEW_COPIES`` times (default 20), a third of them given to one user,
each operator once with whole groups and once with groups cut into chunks. Prints one
JSON line: seconds of both, and the rows of the largest group a task had to order.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.alarm import refund_alarm
from tidemark.operators.changelog import sum_changelog
from tidemark.operators.chunks import CHUNK, SUBCHUNK, add_chunks, plan_cuts
from tidemark.operators.emit import conditional_emit
from tidemark.operators.running import running_sum
from tidemark.plans.tables import table
from tidemark.session import ROWS_PER_CHUNK, local_session

WHOLE, CHUNKED = 1 << 40, 100_000


def skewed_events(spark, sf_dir: str, copies: int) -> DataFrame:
    events = table(spark, sf_dir, "events")
    month = 30 * 24 * 3_600_000
    per_copy = events.count()
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    seq = F.col("event_id") + F.col("copy").cast("bigint") * per_copy
    return many.select(
        seq.alias("seq"),
        (F.unix_millis(F.col("ts").cast("timestamp")) + F.col("copy").cast("bigint") * month).alias("ts_ms"),
        F.when(seq % 3 == 0, 0).otherwise(F.col("user_id") + 1).alias("user_id"),
        F.when(F.col("event_type") == "error", 2).otherwise(1).alias("state"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
    )


def main() -> None:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    folder = tempfile.mkdtemp(prefix="tidemark-skew-")
    spark = local_session(cpus, 4 * cpus, **{"spark.checkpoint.dir": folder})
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("SKEW_COPIES", "20"))
    skewed_events(spark, sf_dir, copies).repartition(4 * cpus).write.parquet(f"{folder}/events")
    events = spark.read.parquet(f"{folder}/events")
    operators = {
        "running_sum": lambda: running_sum(events, "user_id", "seq", "amount"),
        "sum_changelog": lambda: sum_changelog(events),
        "refund_alarm": lambda: refund_alarm(events, within_ms=86_400_000),
        "conditional_emit": lambda: conditional_emit(
            events, "user_id", F.col("state") == 2, horizon_ms=86_400_000
        ),
    }
    seconds: dict[str, dict[str, float]] = {name: {} for name in operators}
    for form, size in (("whole", WHOLE), ("chunked", CHUNKED)):
        spark.conf.set(ROWS_PER_CHUNK[0], size)
        for name, operator in operators.items():
            start = time.perf_counter()
            operator().write.format("noop").mode("overwrite").save()
            seconds[name][form] = round(time.perf_counter() - start, 2)
    cuts = plan_cuts(events, ["user_id"], ["seq"])
    groups = add_chunks(events, ["user_id"], ["seq"], cuts).groupBy("user_id", CHUNK, SUBCHUNK).count()
    largest = {
        "whole": events.groupBy("user_id").count().agg(F.max("count")).first()[0],
        "chunked": groups.agg(F.max("count")).first()[0],
    }
    print(json.dumps({"rows": events.count(), "seconds": seconds, "largest_group": largest}))
    spark.stop()


if __name__ == "__main__":
    main()
