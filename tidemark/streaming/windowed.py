"""Windows of streams whose state is more than one aggregate: folds by a user function, and sliding panes.

Like the operators of ``streaming.carried`` these are ``foreachBatch`` functions that run the bounded
operator over each micro-batch and keep what it adds to each window (or pane). The watermark is the
largest event time of the batches so far less the bound, and moves once per micro-batch; what it has
passed fires. ``open_*`` gives the windows it had not passed when the stream ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import floor_to
from tidemark.operators.windows import fold_records, merge_records
from tidemark.streaming.carried import NUMBER, Batch, Input, _carried, _state

Fold = Callable[[pd.DataFrame], dict]


def _marks(batch: Input, ts_ms: str, bound_ms: int) -> tuple[int | None, int | None, dict]:
    """The watermark before and after a batch, and what to keep of it."""
    before = batch.state.values.get("latest")
    now = batch.rows.agg(F.max(ts_ms)).first()[0]
    after = max([t for t in (before, now) if t is not None], default=None)
    marks = [None if t is None else t - bound_ms for t in (before, after)]
    return marks[0], marks[1], {"latest": after, "mark": marks[1]}


def _behind(time: Column, mark: int | None) -> Column:
    return F.lit(False) if mark is None else time <= mark


def apply_table(
    path: str,
    keys: Sequence[str],
    fold: Fold,
    merge: Fold,
    schema: str,
    width_ms: int = 5_000,
    bound_ms: int = 0,
    lateness_ms: int = 0,
    ts_ms: str = "ts_ms",
    order: Sequence[str] = ("seq",),
) -> Batch:
    """``window_apply`` on a stream: rows ``kind, *keys, start_ms, end_ms, *record``.

    A window fires (``kind`` is ``main``) when the watermark has passed it, and again with each batch that brings
    records in its lateness, always with the record of all its elements so far. What comes later still, and
    records without a time, are ``late`` rows with the record of those elements alone. The state has one record per batch,
    key and window; they are merged by ``merge`` when they fire or are put together.
    """
    keys, names = list(keys), T.StructType.fromDDL(schema).names
    group = [*keys, "start_ms"]

    def combine(rows: DataFrame) -> DataFrame:
        """One record per window, and whether it has fired; a row that says only that has no record."""
        fired = rows.groupBy(*group).agg(F.max("_fired").alias("_fired"), F.max("_held").alias("_held"))
        named = fired.select(*[F.col(c).alias(f"_c_{c}") for c in group], "_fired", "_held")
        merged = merge_records(rows.filter("_held"), group, merge, schema)
        same = F.lit(True)
        for c in group:
            same = same & merged[c].eqNullSafe(named[f"_c_{c}"])
        return named.join(merged, same, "left").select(*[F.col(f"_c_{c}").alias(c) for c in group], "_fired", "_held", *names)

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        before, after, values = _marks(batch, ts_ms, bound_ms)
        end = F.col("start_ms") + width_ms
        elements = batch.rows.drop(NUMBER).withColumn("start_ms", floor_to(F.col(ts_ms), width_ms))
        gone = F.col("start_ms").isNull() | _behind(end + lateness_ms, before)
        new = batch.keep(fold_records(elements.filter(~gone), group, fold, merge, schema))
        late = fold_records(elements.filter(gone), group, fold, merge, schema)
        flags = {"_held": F.lit(True), "_new": F.lit(True)}
        rows = new.withColumns({**flags, "_fired": _behind(end, before)})
        known = batch.state.rows()
        if known is not None:
            open_ = known.filter(~_behind(end + lateness_ms, before)).withColumn("_new", F.lit(False))
            rows = rows.unionByName(open_)
        # Windows the watermark passes now, and those passed before that got elements in their lateness.
        fires = rows.groupBy(*group).agg(F.max("_fired").alias("_was"), F.max("_new").alias("_got"), F.max("_held").alias("_any"))
        fires = fires.filter(_behind(end, after) & F.col("_any") & (~F.col("_was") | F.col("_got")))
        fires = batch.keep(fires.select(*[F.col(c).alias(f"_c_{c}") for c in group]))
        same = F.lit(True)
        for c in group:
            same = same & rows[c].eqNullSafe(fires[f"_c_{c}"])
        firing = merge_records(rows.filter("_held").join(fires, same, "left_semi"), group, merge, schema)
        out = [
            part.select(F.lit(kind).alias("kind"), *keys, "start_ms", end.alias("end_ms"), *names)
            for kind, part in (("main", firing), ("late", late))
        ]
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema).fields]
        marks = fires.select(
            *[F.col(f"_c_{c}").alias(c) for c in group], *nothing, F.lit(False).alias("_held"), F.lit(True).alias("_fired")
        )
        changed = new.withColumns({"_held": F.lit(True), "_fired": F.lit(False)}).unionByName(marks)
        batch.state.merge = lambda runs, whole: combine(runs.filter(~_behind(end + lateness_ms, after)))
        return out[0].unionByName(out[1]), changed, values

    return _carried(path, order, None, step)


def open_records(
    spark: SparkSession, path: str, keys: Sequence[str], merge: Fold, schema: str, width_ms: int = 5_000
) -> DataFrame:
    """The windows of ``apply_table`` that the watermark had not passed at the end of the stream."""
    state = _state(spark, path)
    end = F.col("start_ms") + width_ms
    rows = state.rows().filter(~_behind(end, state.values["mark"])).filter("_held")
    merged = merge_records(rows, [*keys, "start_ms"], merge, schema)
    return merged.select(*keys, "start_ms", end.alias("end_ms"), *T.StructType.fromDDL(schema).names)


def sliding_table(
    path: str,
    keys: Sequence[str],
    width_ms: int,
    slide_ms: int,
    value: Column | None = None,
    name: str = "cnt",
    bound_ms: int = 0,
    ts_ms: str = "ts_ms",
    order: Sequence[str] = ("seq",),
) -> Batch:
    """``sliding_sum`` on a stream: rows ``*keys, start_ms, end_ms, name``, once the watermark passes a window.

    The state has one sum per key and *pane* (a slide wide), not one per window: panes are copied to the
    windows they lie in only when these fire. A late record counts in those of its windows that have not fired.
    """
    if width_ms % slide_ms:
        raise ValueError("the width must be a multiple of the slide")
    keys = list(keys)
    value = F.lit(1).cast("bigint") if value is None else value

    def combine(rows: DataFrame) -> DataFrame:
        type_ = rows.schema["_part"].dataType
        return rows.groupBy(*keys, "_pane").agg(F.sum("_part").cast(type_).alias("_part"))

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        before, after, values = _marks(batch, ts_ms, bound_ms)
        pane = floor_to(F.col(ts_ms), slide_ms).alias("_pane")
        new = batch.rows.groupBy(*keys, pane).agg(F.sum(value).alias("_part")).filter("_pane is not null")
        new = batch.keep(new.filter(~_behind(F.col("_pane") + width_ms, before)))
        known = batch.state.rows()
        panes = new if known is None else new.unionByName(known.filter(~_behind(F.col("_pane") + width_ms, before)))
        fired = _windows(combine(panes), keys, width_ms, slide_ms, name)
        fired = fired.filter(_behind(F.col("end_ms"), after) & ~_behind(F.col("end_ms"), before))
        batch.state.merge = lambda runs, whole: combine(runs.filter(~_behind(F.col("_pane") + width_ms, after)))
        return fired, new, values

    return _carried(path, order, None, step)


def _windows(panes: DataFrame, keys: list[str], width_ms: int, slide_ms: int, name: str) -> DataFrame:
    starts = F.sequence(F.col("_pane") - (width_ms - slide_ms), F.col("_pane"), F.lit(slide_ms).cast("bigint"))
    sums = panes.select(*keys, "_part", F.explode(starts).alias("start_ms")).groupBy(*keys, "start_ms").agg(F.sum("_part").alias(name))
    return sums.select(*keys, "start_ms", (F.col("start_ms") + width_ms).alias("end_ms"), name)


def open_sliding(
    spark: SparkSession, path: str, keys: Sequence[str], width_ms: int, slide_ms: int, name: str = "cnt"
) -> DataFrame:
    """The windows of ``sliding_table`` that the watermark had not passed at the end of the stream."""
    state = _state(spark, path)
    windows = _windows(state.rows(), list(keys), width_ms, slide_ms, name)
    return windows.filter(~_behind(F.col("end_ms"), state.values["mark"]))
