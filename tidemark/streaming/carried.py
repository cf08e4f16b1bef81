"""Ordered operators on streams: the bounded operator per micro-batch, and what it goes on from.

Each of these is a ``foreachBatch`` function. It runs the same distributed operator as for
a bounded table over the micro-batch and what the batches before left behind for its keys (a running
total, the records inside a horizon, a refund that waits for the next, open windows). Of that
it writes only what the batch changed (``streaming.state``), beside the batch's results; both are there once
the batch's commit record is. A batch that is run again overwrites them. No row is handled in
Python and no key's rows are gathered: hot keys are cut into chunks as in a bounded table.

``order`` names the columns that tell the order of arrival within a batch (``seq`` of a
source; several columns, and structs such as those of the file and Kafka sources, are fine).
All rows of a batch arrive after those of the batches before.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.functions.records import REFUNDED
from tidemark.operators.alarm import WITHIN_MS, refund_alarm
from tidemark.operators.changelog import Amounts, Totals, sum_changelog, table_changes
from tidemark.operators.emit import FIRING_WORD, HORIZON_MS, conditional_emit
from tidemark.operators.lateness import ALLOWED_LATE, ON_TIME, TOO_LATE, classify_late, window_end
from tidemark.operators.running import running
from tidemark.session import ROWS_PER_CHUNK, setting
from tidemark.streaming.state import Files, Merge, StateTable, last_commit, latest

Batch = Callable[[DataFrame, int], None]
Aggregates = dict[str, tuple[str, Column]]
# The rows a batch gives, what it changes in the state, and values to keep beside that.
Step = Callable[["Input"], tuple[DataFrame, DataFrame | None, dict]]

NUMBER, OLD = "_number", "_carried"
_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}
# Rows of a batch whose keys, and the state of whose keys, go to every task; more are joined by shuffles.
FEW_KEYS = 200_000


class Input:
    """A micro-batch, its rows numbered along ``order``, and the state before it."""

    def __init__(self, rows: DataFrame, size: int, state: StateTable) -> None:
        self.rows, self.size, self.state = rows, size, state
        self.kept = [rows]
        # Groups of a batch are no larger than the batch: most need no look for hot keys.
        small = size <= setting(rows.sparkSession, ROWS_PER_CHUNK)
        self.cuts: None | str = None if small else "plan"

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, worked out once for all its uses in this batch."""
        self.kept.append(df.persist())
        return df

    def few(self, df: DataFrame) -> DataFrame:
        """``df``, of at most a row for each row of the batch, for a join: sent to every task while that is few."""
        return F.broadcast(df) if self.size <= FEW_KEYS else df

    def known(self, keys: Sequence[str]) -> DataFrame | None:
        """The state's rows of the batch's keys."""
        rows = self.state.rows()
        if rows is None:
            return None
        names = self.few(self.rows.select(*[F.col(f"`{key}`").alias(f"_c_{key}") for key in keys]))
        return rows.join(names, _matches(keys, rows, names), "left_semi")


def _carried(path: str, order: Sequence[str], merge: Merge | None, step: Step) -> Batch:
    """Number the batch's rows along ``order``, run ``step`` over them and write what it gives."""

    def write(batch: DataFrame, batch_id: int) -> None:
        state = StateTable(batch.sparkSession, path, batch_id, merge)
        state.begin()
        # Rows that ``order`` leaves equal, such as lines of one block of a file, stay as read.
        # Numbers increase along the range-partitioned sort; kept, as every use must see the same.
        read = batch.withColumn(NUMBER, F.monotonically_increasing_id()).orderBy(*order, NUMBER)
        numbered = read.withColumn(NUMBER, F.monotonically_increasing_id()).persist()
        work = Input(numbered, numbered.count(), state)
        try:
            rows, changed, values = step(work)
            rows.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
            state.commit(changed, **values)
        finally:
            for kept in work.kept:
                kept.unpersist()

    return write


def _matches(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[f"_c_{key}"]) for key in keys], F.lit(True))


def _named(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"_c_{c}") for c in df.columns])


def running_table(
    path: str, keys: Sequence[str], aggregates: Aggregates, order: Sequence[str] = ("seq",)
) -> Batch:
    """Running aggregates ``{name: ("sum" | "max" | "min", value)}`` per key, one row per record.

    Missing values change nothing; a key that had no value yet has a missing result. The state
    has what each batch adds to a key: partial aggregates, which are combined as they are read.
    """
    keys = list(keys)

    def combine(rows: DataFrame, whole: bool = False) -> DataFrame:
        types = {name: rows.schema[name].dataType for name in aggregates}
        combined = rows.groupBy(*keys).agg(*[_COMBINE[kind](n).alias(n) for n, (kind, _) in aggregates.items()])
        return combined.select(*keys, *[F.col(n).cast(type_).alias(n) for n, type_ in types.items()])

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        out = running(batch.rows, keys, [NUMBER], aggregates, batch.cuts)
        added = batch.rows.groupBy(*keys).agg(*[_COMBINE[kind](v).alias(n) for n, (kind, v) in aggregates.items()])
        known = batch.known(keys)
        if known is not None:
            before = batch.few(_named(combine(known)))
            joined = out.join(before, _matches(keys, out, before), "left")
            merged = {}
            for name, (kind, _) in aggregates.items():
                so_far, now = F.col(f"_c_{name}"), F.col(name)
                both = so_far + now if kind == "sum" else F.greatest(so_far, now) if kind == "max" else F.least(so_far, now)
                merged[name] = F.coalesce(both, now, so_far).cast(out.schema[name].dataType)
            out = joined.withColumns(merged).select(*out.columns)
        return out.drop(NUMBER), added, {}

    return _carried(path, order, combine, step)


def running_sum_table(path: str, key: str, value: str | Column = "cnt", name: str = "total", **options) -> Batch:
    return running_table(path, [key], {name: ("sum", F.col(value) if isinstance(value, str) else value)}, **options)


def running_count_table(path: str, key: str, name: str = "cnt", **options) -> Batch:
    return running_table(path, [key], {name: ("sum", F.lit(1).cast("bigint"))}, **options)


def emit_table(
    path: str,
    key: str,
    predicate: Column | None = None,
    ts_ms: str = "ts_ms",
    order: Sequence[str] = ("seq",),
    horizon_ms: int = HORIZON_MS,
    name: str = "cnt",
) -> Batch:
    """Conditional emission. The state has how many records a key had at each time; those behind the
    horizon are left out where runs are merged, but for a key's last, which says that it was seen."""

    def combine(rows: DataFrame, whole: bool = False) -> DataFrame:
        counts = rows.groupBy(key, ts_ms).agg(F.sum("_records").alias("_records"))
        last = counts.groupBy(F.col(key).alias(f"_c_{key}")).agg(F.max(ts_ms).alias("_last"))
        inside = counts.join(last, _matches([key], counts, last)).filter(F.col(ts_ms) > F.col("_last") - horizon_ms)
        return inside.select(key, ts_ms, "_records")

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        fires = predicate if predicate is not None else F.col(key) == FIRING_WORD
        one = F.lit(1).cast("bigint")
        rows = batch.rows.withColumns({"_fires": fires, OLD: F.lit(False), "_records": one})
        known = batch.known([key])
        if known is not None:
            # Records of before, one row for each time; their numbers tell them apart only.
            old = combine(known).withColumns({OLD: F.lit(True), NUMBER: -1 - F.monotonically_increasing_id()})
            rows = rows.unionByName(old, allowMissingColumns=True)
        out = conditional_emit(rows, key, F.col("_fires") & ~F.col(OLD), ts_ms, NUMBER, horizon_ms, name, "_records")
        added = batch.rows.groupBy(key, ts_ms).agg(F.count("*").alias("_records"))
        return out.select(*[c for c in batch.rows.columns if c != NUMBER], name), added, {}

    return _carried(path, order, combine, step)


def alarm_table(
    path: str,
    key: str = "user_id",
    state: str = "state",
    ts_ms: str | None = None,
    order: Sequence[str] = ("seq",),
    within_ms: int = WITHIN_MS,
) -> Batch:
    """The refund alarm, by the time of the micro-batch or by the event time ``ts_ms``.

    The state has each user's last refund that waits for the user's next record. Only that
    record decides whether it came in time, so other users' times do not matter, even if times fall back.
    The time of a batch stays the same when the batch is run again. Waits that time alone ends, between
    records, are in ``streaming.timers``.
    """

    def merge(rows: DataFrame, whole: bool) -> DataFrame:
        last = latest(rows, [key], "_batch")
        return last.filter("_waits") if whole else last

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        clock = None if ts_ms else batch.state.since("clock", int(time.time() * 1000))
        at = F.col(ts_ms) if ts_ms else F.lit(clock).cast("bigint")
        rows = batch.rows.withColumn("_clock", at).withColumn(OLD, F.lit(False))
        known = batch.known([key])
        if known is not None:
            waiting = latest(known, [key], "_batch").filter("_waits")
            old = waiting.select(
                key, F.lit(REFUNDED).cast(rows.schema[state].dataType).alias(state), "_clock",
                F.lit(-1).cast("bigint").alias(NUMBER), F.lit(True).alias(OLD),
            )
            rows = rows.unionByName(old, allowMissingColumns=True)
        alarms = refund_alarm(rows, key, state, "_clock", NUMBER, within_ms).filter(~F.col(OLD))
        last = rows.filter(~F.col(OLD)).groupBy(key).agg(F.max_by(F.struct(NUMBER, "_clock", state), NUMBER).alias("_last"))
        used = alarms.select(F.col(key).alias(f"_c_{key}"), F.col(NUMBER).alias("_used"))
        used = batch.few(used)
        ended = last.join(used, _matches([key], last, used) & (F.col(f"_last.{NUMBER}") == F.col("_used")), "left")
        waits = F.col("_used").isNull() & F.coalesce(F.col(f"_last.{state}") == REFUNDED, F.lit(False))
        changed = ended.select(
            key, F.col("_last._clock").alias("_clock"), waits.alias("_waits"), F.lit(batch.state.batch_id).cast("bigint").alias("_batch")
        )
        return alarms.select(*[c for c in batch.rows.columns if c != NUMBER]), changed, {}

    return _carried(path, order, merge, step)


def late_table(
    path: str,
    width_ms: int = 5_000,
    bound_ms: int = 2_000,
    lateness_ms: int = 2_000,
    first: bool = True,
    order: Sequence[str] = ("seq",),
    per_record: bool = False,
) -> Batch:
    """Tumbling windows of ``word`` with allowed lateness and a side output, over ``ts_ms, word, cnt``.

    The watermark is the largest event time less the bound: of all batches before, moving once per
    micro-batch, or, ``per_record``, of all records before, as in ``classify_late`` over the whole stream, however it
    is cut into batches. Every record either reaches its window or is a ``late`` row (also one
    without a time, whose ``end_ms`` is missing). ``main`` has a row (first element when
    ``first``, else the sum) when the watermark passes a window and again for each record in its lateness.
    The state has what each batch adds to a window; windows that are gone are left out where runs are merged.
    """

    def combine(rows: DataFrame, whole: bool = False) -> DataFrame:
        return rows.groupBy("word", "end_ms").agg(
            F.sum("total").alias("total"), F.min_by("first", "at").alias("first"), F.min("at").alias("at"),
            F.max("fired").alias("fired"),
        )

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        before = batch.state.values.get("latest")
        now = batch.rows.agg(F.max("ts_ms")).first()[0]
        after = max([t for t in (before, now) if t is not None], default=None)
        mark = F.lit(None if after is None else after - bound_ms).cast("bigint")
        if per_record:
            rows = classify_late(batch.rows, "ts_ms", NUMBER, width_ms, bound_ms, lateness_ms, before)
        else:
            met = F.lit(None if before is None else before - bound_ms).cast("bigint")
            end = window_end("ts_ms", width_ms)
            late_class = F.when(F.col("ts_ms").isNull() | (end + lateness_ms <= met), TOO_LATE).when(end <= met, ALLOWED_LATE)
            rows = batch.rows.withColumns({"end_ms": end, "late_class": late_class.otherwise(ON_TIME)})
        at = F.struct(F.lit(batch.state.batch_id).cast("bigint").alias("batch"), F.col(NUMBER).alias("number"))
        rows = batch.keep(rows.withColumns({"cnt": F.col("cnt").cast("bigint"), "at": at}))
        kept = rows.filter(F.col("late_class") != TOO_LATE)
        on_time = F.col("late_class") == ON_TIME
        added = kept.groupBy("word", "end_ms").agg(
            F.sum("cnt").alias("total"), F.min_by("cnt", "at").alias("first"), F.min("at").alias("at"),
            F.sum(F.when(on_time, F.col("cnt"))).alias("_on_time"), F.max(on_time).alias("_new"), F.max(~on_time).alias("fired"),
        )
        added = batch.keep(added)
        known = batch.state.rows()
        if known is not None:
            open_ = known if before is None else known.filter(F.col("end_ms") + lateness_ms > before - bound_ms)
            old = combine(open_)
        else:
            old = added.select("word", "end_ms", "total", "first", "at", "fired").limit(0)
        window = ["word", "end_ms"]
        before_ = _named(old)
        windows = added.join(before_, _matches(window, added, before_), "full_outer")
        windows = windows.select(
            F.coalesce("word", "_c_word").alias("word"), F.coalesce("end_ms", "_c_end_ms").alias("end_ms"),
            F.coalesce("_c_first", "first").alias("first"), F.coalesce("_c_total", F.lit(0)).alias("_so_far"),
            F.coalesce("_on_time", F.lit(0)).alias("_on_time"), F.coalesce("_c_fired", F.lit(False)).alias("fired"),
            F.coalesce("_new", F.lit(False)).alias("_new"),
            F.col("_c_total").isNotNull().alias("_was"),
        )
        windows = batch.keep(windows)
        # Of the elements at hand when the watermark passes a window, the first or the sum.
        passes = ~F.col("fired") & (F.col("end_ms") <= mark) & (F.col("_was") | F.col("_new"))
        value = F.col("first") if first else F.col("_so_far") + F.col("_on_time")
        firing = windows.filter(passes).select("word", "end_ms", value.alias("cnt"))
        again = rows.filter(F.col("late_class") == ALLOWED_LATE).select("word", "end_ms", "cnt", NUMBER)
        if not first:
            again = running(again, window, [NUMBER], {"_sum": ("sum", F.col("cnt"))}, batch.cuts)
        held = _named(windows.select("word", "end_ms", "first", "_so_far", "_on_time"))
        again = again.join(held, _matches(window, again, held), "left")
        value = F.col("_c_first") if first else F.col("_sum") + F.col("_c__so_far") + F.col("_c__on_time")
        again = again.select("word", "end_ms", value.alias("cnt"))
        late = rows.filter(F.col("late_class") == TOO_LATE).select("word", "end_ms", "cnt")
        columns = ("word", "cnt", (F.col("end_ms") - width_ms).alias("start_ms"), "end_ms")
        made = [
            part.select(F.lit(kind).alias("kind"), *columns)
            for kind, part in (("main", again), ("main", firing), ("late", late))
        ]
        # Only windows that got elements or have fired now are written.
        fired = windows.filter(passes).select(
            "word", "end_ms", F.lit(0).cast("bigint").alias("total"), F.lit(None).cast("bigint").alias("first"),
            F.lit(None).cast(added.schema["at"].dataType).alias("at"), F.lit(True).alias("fired"),
        )
        changed = added.select("word", "end_ms", "total", "first", "at", "fired").unionByName(fired)
        if after is not None:
            batch.state.merge = lambda runs, whole: combine(runs).filter(F.col("end_ms") + lateness_ms > after - bound_ms)
        return reduce(DataFrame.union, made), changed, {"latest": after}

    return _carried(path, order, combine, step)


def changelog_table(
    path: str, amount: str = "amount", order: Sequence[str] = ("seq",), scale: int | None = None, label: str = "seq"
) -> Batch:
    """The changelog of the total of all batches so far; a few numbers go from batch to batch.

    The total is kept as exact sums: bigint, a decimal of 38 digits, or the bits of doubles.
    """

    def step(batch: Input) -> tuple[DataFrame, None, dict]:
        held = batch.state.values
        sums = {name: exact.number(value) for name, value in held.get("sums", {}).items()}
        before = Totals(held.get("records", 0), held.get("known", 0), sums)
        changes = sum_changelog(batch.rows, NUMBER, amount, scale, before, label)
        parts = Amounts(batch.rows, amount, scale, exact.places_of(sums)).parts
        added = batch.rows.agg(
            F.count("*").alias("records"), F.count(amount).alias("known"), *[F.sum(p).alias(n) for n, p in parts.items()]
        ).first()
        now = {name: (added[name] or 0) + sums.get(name, 0) for name in {*parts, *sums}}
        return changes, None, {
            "records": before.records + added["records"],
            "known": before.known + added["known"],
            "sums": {name: str(value) for name, value in exact.carried(now).items()},
        }

    return _carried(path, order, None, step)


def group_changelog_table(
    path: str, keys: Sequence[str], amount: str = "amount", order: Sequence[str] = ("seq",), scale: int | None = 6, label: str = "seq"
) -> Batch:
    """The changelog of ``SUM(amount) GROUP BY keys``, record by record.

    The state has what each batch adds to a key; doubles are summed as decimals of ``scale`` places.
    """
    keys = list(keys)

    def combine(rows: DataFrame, whole: bool = False) -> DataFrame:
        type_ = rows.schema["sum"].dataType
        total = F.sum("sum").cast(type_).alias("sum")
        return rows.groupBy(*keys).agg(F.sum("records").alias("records"), F.sum("known").alias("known"), total)

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        known = batch.known(keys)
        changes = sum_changelog(batch.rows, NUMBER, amount, scale, None if known is None else batch.few(combine(known)), label, keys)
        value = Amounts(batch.rows, amount, scale).parts["sum"]
        added = batch.rows.groupBy(*keys).agg(
            F.count("*").alias("records"), F.count(amount).alias("known"), F.sum(value).cast(_sum_type(batch.rows, value)).alias("sum")
        )
        return changes, added, {}

    return _carried(path, order, combine, step)


def _sum_type(df: DataFrame, value: Column) -> object:
    return df.select(value.alias("v")).schema["v"].dataType


def update_table(path: str, keys: Sequence[str]) -> Batch:
    """The latest row of each key of an aggregation in update mode, and its changelog.

    Each batch brings the new rows of the keys it changed; ``read_rows`` gives the changes (``+I``, ``-U`` and
    ``+U`` rows with ``batch``), ``read_latest`` the table. What is read for either follows the keys, not
    the updates ever made.
    """
    keys = list(keys)

    def merge(rows: DataFrame, whole: bool = False) -> DataFrame:
        return latest(rows, keys, "_batch")

    def step(batch: Input) -> tuple[DataFrame, DataFrame, dict]:
        new = batch.rows.drop(NUMBER)
        known = batch.known(keys)
        old = batch.few(merge(known).drop("_batch")) if known is not None else new.limit(0)
        number = F.lit(batch.state.batch_id).cast("bigint")
        changes = table_changes(old, new, keys)
        return changes.withColumn("batch", number), new.withColumn("_batch", number), {}

    return _carried(path, keys, merge, step)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table that ``update_table`` keeps."""
    rows = _state(spark, path).rows()
    return latest(rows, list(keys), "_batch").drop("_batch")


def _state(spark: SparkSession, path: str) -> StateTable:
    """The state after the last whole batch."""
    done = last_commit(spark, path)
    if done is None:
        raise ValueError(f"{path} has no whole batch yet")
    return StateTable(spark, path, done + 1)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows the whole batches of one of these tables gave."""
    done = last_commit(spark, path)
    if done is None:
        raise ValueError(f"{path} has no whole batch yet")
    names = [name for name in Files(spark, path).names("rows") if int(name.split("=")[1]) <= done]
    return spark.read.option("basePath", f"{path}/rows").parquet(*[f"{path}/rows/{name}" for name in names]).drop("batch_id")


def read_kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The ``main`` or the ``late`` output of ``late_table``."""
    return read_rows(spark, path).filter(F.col("kind") == kind).drop("kind")


def open_windows(spark: SparkSession, path: str, batch_id: int | None = None, first: bool = True) -> DataFrame:
    """Final flush: the windows the watermark had not passed when a bounded stream ended, or
    after batch ``batch_id``, one of the last two."""
    state = _state(spark, path) if batch_id is None else StateTable(spark, path, batch_id + 1)
    rows = state.rows()
    windows = rows.groupBy("word", "end_ms").agg(
        F.sum("total").alias("total"), F.min_by("first", "at").alias("first"), F.max("fired").alias("fired")
    )
    return windows.filter("NOT fired").select("word", F.col("first" if first else "total").alias("cnt"), "end_ms")
