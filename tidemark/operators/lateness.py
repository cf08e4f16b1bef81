"""Out-of-order records against a watermark: on time, allowed late, too late.

The watermark a record meets is the largest event time of the records before it,
less the bound. A running maximum over the whole arrival order would sort the whole
table. It is not needed: a window end ``e`` is passed for every record that arrives
after the *first* record with an event time of ``e + bound`` or more. One small table
with that arrival number per window end decides for all records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.casts import floor_to

ON_TIME, ALLOWED_LATE, TOO_LATE = "on_time", "allowed_late", "too_late"

# The arrival number of all that came before a table: its own are larger.
BEFORE = -(1 << 62)
_BLOCK = 10_000
# Windows of a part of the time line.
_WINDOWS = 1 << 16


def window_end(ts_ms: str, width_ms: int) -> Column:
    return floor_to(F.col(ts_ms), width_ms) + width_ms


def _passings(
    df: DataFrame, ts_ms: str, seq: str, width_ms: int, bound_ms: int, lateness_ms: int, latest_ms: int | None
) -> DataFrame:
    """Per window end: arrival number from which it is closed, and from which it is gone."""

    def ends(at: Column) -> list[Column]:
        # The last window end a record passes, with lateness as well, and the one it needs.
        return [
            floor_to(at - bound_ms, width_ms).alias("passed"),
            floor_to(at - (bound_ms + lateness_ms), width_ms).alias("passed_late"),
            (floor_to(at, width_ms) + width_ms).alias("needed"),
        ]

    # Combined first, so that only a few rows per window are made into three.
    firsts = df.groupBy(*ends(F.col(ts_ms))).agg(F.min(seq).alias("first"))
    if latest_ms is not None:
        # What came before ``df`` passed its windows before any record of it.
        before = df.sparkSession.range(1).select(*ends(F.lit(latest_ms).cast("bigint")), F.lit(BEFORE).alias("first"))
        firsts = firsts.unionByName(before.withColumn("needed", F.lit(None).cast("bigint")))
    nothing = F.lit(None).cast("bigint")

    def point(end: str, closed: Column, gone: Column, used: bool) -> Column:
        return F.struct(
            F.col(end).alias("end_ms"), closed.alias("closed"), gone.alias("gone"), F.lit(used).alias("used")
        )

    first = F.col("first")
    points = (
        firsts.select(
            F.inline(
                F.array(
                    point("passed", first, nothing, False),
                    point("passed_late", nothing, first, False),
                    point("needed", nothing, nothing, True),
                )
            )
        )
        .groupBy("end_ms")
        .agg(F.min("closed").alias("closed"), F.min("gone").alias("gone"), F.max("used").alias("used"))
        .withColumn("part", F.floor(F.col("end_ms") / (width_ms * _WINDOWS)))
    )
    # Passing a window end passes all earlier ones: minimum over this end and later ones, first within a
    # part of the time line, and then over the later parts, of which there are few.
    later = Window.partitionBy("part").orderBy(F.desc("end_ms")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later_parts = Window.partitionBy(F.lit(0)).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    parts = points.groupBy("part").agg(F.min("closed").alias("_closed"), F.min("gone").alias("_gone")).select(
        "part", F.min("_closed").over(later_parts).alias("_closed"), F.min("_gone").over(later_parts).alias("_gone")
    )
    within = points.withColumns({"closed": F.min("closed").over(later), "gone": F.min("gone").over(later)})
    return within.where("used").join(parts, "part").select(
        "end_ms", F.least("closed", "_closed").alias("closed"), F.least("gone", "_gone").alias("gone")
    )


def classify_late(
    df: DataFrame,
    ts_ms: str = "ts_ms",
    seq: str = "seq",
    width_ms: int = 5_000,
    bound_ms: int = 2_000,
    lateness_ms: int = 0,
    latest_ms: int | None = None,
) -> DataFrame:
    """Add ``end_ms`` (of the record's tumbling window) and ``late_class`` to every record.

    ``latest_ms`` is the largest event time of records that came before ``df``, if there are any. A record
    without an event time has no window to reach: it is too late.
    """
    ends = _passings(df, ts_ms, seq, width_ms, bound_ms, lateness_ms, latest_ms)
    # One row per window: Spark broadcasts it if it is small, else splits hot windows itself.
    joined = df.withColumn("end_ms", window_end(ts_ms, width_ms)).join(ends, "end_ms", "left")
    late_class = (
        F.when(F.col(ts_ms).isNull() | (F.col(seq) > F.col("gone")), TOO_LATE)
        .when(F.col(seq) > F.col("closed"), ALLOWED_LATE if lateness_ms else TOO_LATE)
        .otherwise(ON_TIME)
    )
    return joined.select(*df.columns, "end_ms", late_class.alias("late_class"))


def kept(classified: DataFrame) -> DataFrame:
    """Records that reach their window."""
    return classified.where(F.col("late_class") != TOO_LATE)


def side_output(classified: DataFrame) -> DataFrame:
    """Records too late for their window."""
    return classified.where(F.col("late_class") == TOO_LATE)


def firings(
    classified: DataFrame, keys: Sequence[str], seq: str = "seq", payload: Sequence[str] = ("cnt",)
) -> DataFrame:
    """How often every (key, window) fires, and the first element each firing gives.

    A window fires once for its on-time records and again for each allowed late one.
    """
    on_time = F.max((F.col("late_class") == ON_TIME).cast("int"))
    again = F.count_if(F.col("late_class") == ALLOWED_LATE)
    return (
        kept(classified)
        .groupBy(*keys, "end_ms")
        .agg((on_time + again).alias("firings"), *[F.min_by(c, seq).alias(c) for c in payload])
    )


def firing_rows(fired: DataFrame) -> DataFrame:
    """One row per firing, from the one row per (key, window) ``firings`` gives."""
    # In blocks, spread out before the rows are made: one window may fire very often.
    blocks = fired.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), ((F.col("firings") - 1) / _BLOCK).cast("int")))
    ).repartition(*fired.columns, "_block")
    in_block = F.least(F.col("firings") - F.col("_block") * _BLOCK, F.lit(_BLOCK))
    return blocks.withColumn("_row", F.explode(F.sequence(F.lit(1), in_block.cast("int")))).drop(
        "firings", "_block", "_row"
    )


def kept_sums(
    classified: DataFrame, keys: Sequence[str], value: str = "cnt", name: str = "cnt"
) -> DataFrame:
    """Final window sums over the records that reach their window."""
    return kept(classified).groupBy(*keys, "end_ms").agg(F.sum(value).alias(name))
