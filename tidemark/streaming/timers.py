"""Keyed state with timers: what waits for a record ends when its time is up, without one.

These are Structured Streaming operators (``transformWithState``): a value per key in Spark's state
store, of which a batch writes only what it changed, and timers that Spark keeps beside it. By processing time a
trigger is enough for a timer to fire; by event time any user's record that moves the watermark is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.records import REFUNDED
from tidemark.operators.alarm import WITHIN_MS

# Task functions travel with the query, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALARM, EXPIRED = "alarm", "expired"


class RefundWait(StatefulProcessor):
    """A user's refund waits for the user's next record, until its time is up."""

    def __init__(self, payload: Sequence[str], names: Sequence[str], n_order: int, within_ms: int, timed: bool) -> None:
        self.payload, self.names, self.n_order = list(payload), list(names), n_order
        self.columns = [self.names[0], *self.payload, "_state", "_at", *[f"_o{i}" for i in range(n_order)]]
        self.columns += ["_ts"] if timed else []
        self.order = [self.columns.index(f"_o{i}") for i in range(n_order)]
        self.within_ms, self.timed = within_ms, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.since = handle.getValueState("since", "at bigint")

    def _made(self, key: tuple, rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame([{**dict.fromkeys(self.names), self.names[0]: key[0], **row} for row in rows], columns=self.names)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        # Spark names computed columns anew: they are known by their places. A user has few records in a batch,
        # for which frames cost far more than lists.
        values = [row for part in rows for row in part.to_numpy(dtype=object).tolist()]
        if len(values) > 1:
            values.sort(key=lambda row: [(False, 0) if pd.isna(row[i]) else (True, row[i]) for i in self.order])
        records = [dict(zip(self.columns, row, strict=True)) for row in values]
        now = None if self.timed else timerValues.getCurrentProcessingTimeInMs()
        old = since = self.since.get()[0] if self.since.exists() else None
        made = []
        for record in records:
            at = int(record["_at"]) if self.timed else now
            refund = record["_state"] == REFUNDED
            if refund and since is not None and at < since + self.within_ms:
                made.append({"kind": ALARM, "at_ms": at, **{c: record[c] for c in self.payload}})
                since = None
            else:
                since = at if refund else None
        if since != old:
            if old is not None:
                self.handle.deleteTimer(old + self.within_ms)
            if since is None:
                self.since.clear()
            else:
                self.since.update((since,))
                self.handle.registerTimer(since + self.within_ms)
        if made:
            yield self._made(key, made)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        self.since.clear()
        yield self._made(key, [{"kind": EXPIRED, "at_ms": expiredTimerInfo.getExpiryTimeInMs()}])

    def close(self) -> None:
        pass


def _as_read(df: DataFrame) -> DataFrame:
    """Add ``_read``, a row's place among those its task reads."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = 0
        for batch in batches:
            places = pa.array(range(so_far, so_far + batch.num_rows), pa.int64())
            so_far += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, places], names=[*batch.schema.names, "_read"])

    return df.mapInArrow(number, T.StructType([*df.schema.fields, T.StructField("_read", T.LongType())]))


def refund_waits(
    df: DataFrame,
    key: str = "user_id",
    state: str = "state",
    ts_ms: str | None = None,
    order: Sequence[str] = ("seq",),
    within_ms: int = WITHIN_MS,
    bound: str = "0 seconds",
    payload: Sequence[str] = (),
) -> DataFrame:
    """The refund alarm of a stream as rows ``(key, kind, at_ms, *payload)``: ``alarm`` for the second of two refunds
    within ``within_ms``, ``expired`` when a refund's time is up before the user's next record.

    By processing time, which is that of the micro-batch and stays with it when it is run again; or by the event
    time ``ts_ms``, where a wait ends when the watermark, ``bound`` behind the largest time, has passed its end, and
    records behind the watermark are left out, those without a time as well. ``order`` tells the order within a
    batch; a query by processing time has timers to look after for ever and does not end by itself, as
    ``run_to_end`` waits for; ``payload`` are columns of the alarming record to give. A task sorts one user's records of one micro-batch.
    """
    keys: list = []
    for column in order:
        kind = df.schema[column].dataType
        keys += [F.col(f"{column}.{f}") for f in kind.names] if isinstance(kind, T.StructType) else [F.col(column)]
    if any(isinstance(df.schema[column].dataType, T.StructType) for column in order):
        # The lines of one block of a file have one struct: they stay as read.
        df = _as_read(df)
        keys.append(F.col("_read"))
    at = F.col(ts_ms).cast("bigint") if ts_ms else F.lit(None).cast("bigint")
    rows = df.select(
        key, *payload, F.col(state).alias("_state"), at.alias("_at"), *[k.alias(f"_o{i}") for i, k in enumerate(keys)],
    )
    if ts_ms:
        rows = rows.filter("_at is not null").withColumn("_ts", F.timestamp_millis("_at")).withWatermark("_ts", bound)
    fields = [rows.schema[key], T.StructField("kind", T.StringType()), T.StructField("at_ms", T.LongType())]
    schema = T.StructType([*fields, *[rows.schema[c] for c in payload]])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    waits = RefundWait(payload, schema.names, len(keys), within_ms, ts_ms is not None)
    return rows.groupBy(key).transformWithStateInPandas(waits, schema, "append", "EventTime" if ts_ms else "ProcessingTime")
