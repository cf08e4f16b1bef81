"""Event-time windows. All forms but ``sliding_sum`` and ``window_apply`` also run on streams;
those have forms of their own there, in ``streaming.windowed``."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import floor_to, to_millis

# Fixed value: the label of the relabelling step.
TOTAL_LABEL = "合计"


def with_watermark(df: DataFrame, ts: str = "ts", bound: str = "0 seconds") -> DataFrame:
    """Watermark ``bound`` behind the largest event time seen."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, bound)


def with_ingest_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Stamp rows with the time they are read (one value per micro-batch), watermark 0."""
    return df.withColumn(ts, F.current_timestamp()).withWatermark(ts, "0 seconds")


def windowed(
    df: DataFrame,
    ts: str,
    width: str,
    keys: Sequence[str],
    slide: str | None = None,
    **aggregates: Column,
) -> DataFrame:
    """Aggregates per key and epoch-aligned window ``[start, end)``; sliding with ``slide``."""
    out = df.groupBy(F.window(ts, width, slide), *keys).agg(
        *[value.alias(name) for name, value in aggregates.items()]
    )
    return out.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *aggregates,
    )


def tumbling_count(df: DataFrame, ts: str, width: str, keys: Sequence[str]) -> DataFrame:
    return windowed(df, ts, width, keys, cnt=F.count("*"))


def tumbling_sum(
    df: DataFrame, ts: str, width: str, keys: Sequence[str], value: str = "cnt", name: str = "cnt"
) -> DataFrame:
    return windowed(df, ts, width, keys, **{name: F.sum(value)})


def window_first(
    df: DataFrame, ts: str, width: str, keys: Sequence[str], seq: str, payload: Sequence[str]
) -> DataFrame:
    """The first record (by ``seq``) of every key and window."""
    return windowed(df, ts, width, keys, **{c: F.min_by(c, seq) for c in payload})


def relabel_double(counts: DataFrame, word: str = "word", cnt: str = "cnt") -> DataFrame:
    """Every (word, window) row as ``(label, 2 * cnt)``; words are not added together."""
    return counts.withColumns({word: F.lit(TOTAL_LABEL), cnt: F.col(cnt) * 2})


def sliding_sum(
    df: DataFrame,
    ts_ms: str,
    width_ms: int,
    slide_ms: int,
    keys: Sequence[str],
    value: Column | None = None,
    name: str = "cnt",
) -> DataFrame:
    """Sum (or count) per key and sliding window, ``width_ms`` a multiple of ``slide_ms``.

    Rows are summed once into panes one slide wide and only the panes are copied to
    the windows they lie in, so the copies do not grow with the rows.
    """
    if width_ms % slide_ms:
        raise ValueError("the width must be a multiple of the slide")
    value = F.lit(1).cast("bigint") if value is None else value
    panes = df.groupBy(*keys, floor_to(F.col(ts_ms), slide_ms).alias("_pane")).agg(
        F.sum(value).alias("_part")
    )
    starts = F.sequence(
        F.col("_pane") - (width_ms - slide_ms), F.col("_pane"), F.lit(slide_ms).cast("bigint")
    )
    return (
        panes.select(*keys, "_part", F.explode(starts).alias("start_ms"))
        .groupBy(*keys, "start_ms")
        .agg(F.sum("_part").alias(name))
        .select(*keys, "start_ms", (F.col("start_ms") + width_ms).alias("end_ms"), name)
    )


def fold_records(
    elements: DataFrame,
    group: Sequence[str],
    fold: Callable[[pd.DataFrame], dict],
    merge: Callable[[pd.DataFrame], dict],
    schema: str,
    salts: int = 256,
) -> DataFrame:
    """One record of ``schema`` per group: ``fold`` over batches of its elements, then ``merge``.

    Elements are folded batch by batch where they are read and the records merged in two
    rounds, the first salted, so no task ever holds all elements of a group.
    """
    group = list(group)
    record = T.StructType.fromDDL(schema)
    state = T.StructType([*elements.select(*group).schema.fields, *record.fields])
    salted = T.StructType([*state.fields, T.StructField("_salt", T.IntegerType())])

    def fold_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first_salt = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            records = [
                {**dict(zip(group, names)), **fold(part.reset_index(drop=True))}
                for names, part in batch.groupby(group, dropna=False, sort=False)
            ]
            if records:
                yield pd.DataFrame(records).assign(_salt=(first_salt + i) % salts)[salted.names]

    folded = elements.mapInPandas(fold_batches, salted)
    return merge_records(merge_records(folded, [*group, "_salt"], merge, schema).drop("_salt"), group, merge, schema)


def merge_records(records: DataFrame, group: Sequence[str], merge: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """One record per group of several, merged by ``merge``."""
    names = T.StructType.fromDDL(schema).names
    lists = records.groupBy(*group).agg(F.collect_list(F.struct(*names)).alias("_records"))
    state = T.StructType([*lists.select(*group).schema.fields, *records.select(*names).schema.fields])

    def merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *key_columns, lists = batch.columns
            flat = pa.RecordBatch.from_struct_array(lists.flatten())
            records, parts = flat.to_pylist(), flat.to_pandas(integer_object_nulls=True)
            merged, start = [], 0
            for length in lists.value_lengths().to_pylist():
                end = start + length
                if length == 1:
                    merged.append(records[start])
                else:
                    merged.append(merge(parts.iloc[start:end].reset_index(drop=True)))
                start = end
            columns = pa.array(merged, type=lists.type.value_type).flatten()
            yield pa.RecordBatch.from_arrays([*key_columns, *columns], names=state.names)

    return lists.mapInArrow(merge_batches, state)


def window_apply(
    df: DataFrame,
    ts: str,
    width_ms: int,
    keys: Sequence[str],
    fold: Callable[[pd.DataFrame], dict],
    merge: Callable[[pd.DataFrame], dict],
    schema: str,
    salts: int = 256,
) -> DataFrame:
    """A user function over all elements of each key and window.

    ``fold`` turns some elements of one window into one record of ``schema``,
    ``merge`` several such records into one (see ``fold_records``). ``apply_table`` is its form on streams.
    """
    elements = df.withColumn("start_ms", floor_to(to_millis(F.col(ts)), width_ms))
    merged = fold_records(elements, [*keys, "start_ms"], fold, merge, schema, salts)
    names = T.StructType.fromDDL(schema).names
    return merged.select(*keys, "start_ms", (F.col("start_ms") + width_ms).alias("end_ms"), *names)
