"""Refund alarm: the second of two refunds in a row by one user within a minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.records import REFUNDED
from tidemark.operators.chunks import CHUNK, IS_HOT, SUBCHUNK, add_chunks, plan_cuts, reserve
from tidemark.operators.running import REAL

WITHIN_MS = 60_000


def refund_alarm(
    df: DataFrame,
    key: str = "user_id",
    state: str = "state",
    ts_ms: str = "ts_ms",
    seq: str = "seq",
    within_ms: int = WITHIN_MS,
) -> DataFrame:
    """Rows of ``df`` that raise an alarm.

    Per user in ``seq`` order, a row *continues a streak* when it and the row before
    are refunds less than ``within_ms`` apart. An alarm uses up both its refunds, so
    within a streak every second row is one.
    """
    reserve(df, "_at", "_refund", "_weight", REAL, "_starts", "_streak", "_sum", "_place")
    cuts = plan_cuts(df, [key], [seq])
    rows = df.withColumns(
        {
            "_at": F.col(ts_ms),
            "_refund": F.coalesce(F.col(state) == REFUNDED, F.lit(False)),
            "_weight": F.lit(1).cast("bigint"),
            REAL: F.lit(True),
        }
    )
    parts = [key]
    if cuts is not None:
        rows = add_chunks(rows, [key], [seq], cuts)
        rows = rows.unionByName(_carries(rows, key, seq, within_ms), allowMissingColumns=True)
        parts = [key, CHUNK, SUBCHUNK]
    placed = _streak_places(rows, parts, [REAL, seq], within_ms)
    alarm = F.col(REAL) & F.col("_refund") & (F.col("_place") % 2 == 0)
    return placed.where(alarm).select(*df.columns)


def _continues(spec: Window, within_ms: int) -> Column:
    """Whether a row continues the streak of the row before it."""
    before, since = F.lag("_refund").over(spec), F.lag("_at").over(spec)
    return F.coalesce(
        F.col("_refund") & before & (F.col("_at") < since + within_ms), F.lit(False)
    )


def _streak_places(df: DataFrame, parts: list[str], order: list[str], within_ms: int) -> DataFrame:
    """Add ``_streak`` (number of the streak in its part) and ``_place`` inside it."""
    spec = Window.partitionBy(*parts).orderBy(*order)
    so_far = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_streak = F.when(F.col("_starts") == 1, F.col("_sum") - F.col("_weight"))
    return (
        df.withColumn("_starts", 1 - _continues(spec, within_ms).cast("int"))
        .withColumns(
            {"_streak": F.sum("_starts").over(so_far), "_sum": F.sum("_weight").over(so_far)}
        )
        .withColumn("_place", F.col("_sum") - F.max(before_streak).over(so_far))
    )


def _carries(rows: DataFrame, key: str, seq: str, within_ms: int) -> DataFrame:
    """Per hot (user, chunk): the last row before the chunk, weighing as much as the
    streak it ends is long."""
    local = _streak_places(rows.where(IS_HOT), [key, CHUNK, SUBCHUNK], [seq], within_ms)
    chunk = local.groupBy(key, CHUNK, SUBCHUNK).agg(
        F.min_by("_at", seq).alias("_first_at"),
        F.min_by("_refund", seq).alias("_first_refund"),
        F.max_by("_at", seq).alias("_at"),
        F.max_by("_refund", seq).alias("_refund"),
        F.max_by("_place", seq).alias("_length"),
        F.max("_streak").alias("_streaks"),
    )
    # A chunk that is one single streak, continuing the chunk before, lengthens that
    # chunk's last streak; any other chunk's last streak begins inside it.
    along = Window.partitionBy(key).orderBy(CHUNK, SUBCHUNK)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = F.coalesce(
        F.col("_first_refund")
        & F.lag("_refund").over(along)
        & (F.col("_first_at") < F.lag("_at").over(along) + within_ms),
        F.lit(False),
    )
    whole = (
        chunk.withColumn("_joined", joined)
        # The part of the chunk's last streak that lies before it counts when the
        # chunk is nothing but that streak.
        .withColumn("_begins", (~(F.col("_joined") & (F.col("_streaks") == 1))).cast("int"))
        .withColumn("_run", F.sum("_begins").over(so_far))
        .withColumn(
            "_weight",
            F.sum("_length").over(
                Window.partitionBy(key, "_run")
                .orderBy(CHUNK, SUBCHUNK)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    )
    # Chunks 1, 2, … start from the state chunk 0, 1, … ended in.
    return whole.select(
        key,
        F.lead(CHUNK).over(along).alias(CHUNK),
        F.lead(SUBCHUNK).over(along).alias(SUBCHUNK),
        "_at",
        "_refund",
        "_weight",
        F.lit(False).alias(REAL),
    ).where(F.col(CHUNK).isNotNull())
