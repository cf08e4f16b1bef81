"""Keyed rolling aggregation: one updated result per input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.chunks import CHUNK, IS_HOT, SUBCHUNK, Cuts, add_chunks, plan_cuts

REAL = "_real"
_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: dict[str, tuple[str, Column]],
    cuts: Cuts | None | str = "plan",
) -> DataFrame:
    """Add running aggregates ``{name: ("sum" | "max" | "min", value)}``.

    Rows are taken per ``keys`` in ``order`` (one or two integer columns, see
    ``plan_cuts``); no keys means one order over the whole table. Every input row
    gives one output row. Sums should be over integers or decimals. Callers that know
    a bound of the group sizes pass their own ``cuts``, or None for none.
    """
    if cuts == "plan":
        cuts = plan_cuts(df, keys, order)
    if cuts is None:
        rows = df
        values = {name: value for name, (_, value) in aggregates.items()}
        spec = Window.partitionBy(*keys or [F.lit(0)]).orderBy(*order)
    else:
        rows = add_chunks(df, keys, order, cuts).withColumn(REAL, F.lit(True))
        rows = rows.unionByName(_carries(rows, keys, aggregates), allowMissingColumns=True)
        values = {
            name: F.when(F.col(REAL), value).otherwise(F.col(_carry(name)))
            for name, (_, value) in aggregates.items()
        }
        spec = Window.partitionBy(*keys, CHUNK, SUBCHUNK).orderBy(REAL, *order)
    spec = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    out = rows.withColumns(
        {name: _COMBINE[kind](values[name]).over(spec) for name, (kind, _) in aggregates.items()}
    )
    if cuts is not None:
        out = out.where(REAL)
    return out.select(*df.columns, *aggregates)


def _carry(name: str) -> str:
    return f"_carry_{name}"


def _carries(
    rows: DataFrame, keys: Sequence[str], aggregates: dict[str, tuple[str, Column]]
) -> DataFrame:
    """One row per hot (key, chunk): the aggregate of all the chunks before it."""
    totals = (
        rows.where(IS_HOT)
        .groupBy(*keys, CHUNK, SUBCHUNK)
        .agg(*[_COMBINE[kind](value).alias(_carry(n)) for n, (kind, value) in aggregates.items()])
    )
    before = (
        Window.partitionBy(*keys or [F.lit(0)])
        .orderBy(CHUNK, SUBCHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.withColumns(
        {_carry(n): _COMBINE[kind](_carry(n)).over(before) for n, (kind, _) in aggregates.items()}
    ).withColumn(REAL, F.lit(False))


def running_sum(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    value: str | Column = "cnt",
    name: str = "total",
) -> DataFrame:
    """Running sum of ``value`` per key, one row per record; the first passes unchanged."""
    return running(df, _names(key), _names(order), {name: ("sum", _column(value))})


def running_count(
    df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], name: str = "cnt"
) -> DataFrame:
    """Running number of records per key, one row per record."""
    return running(
        df, _names(key), _names(order), {name: ("sum", F.lit(1).cast("bigint"))}
    )


def final_sum(
    df: DataFrame, key: str | Sequence[str], value: str | Column = "cnt", name: str = "total"
) -> DataFrame:
    """The last state of ``running_sum``: one row per key. Also the streaming update form."""
    return df.groupBy(*_names(key)).agg(F.sum(_column(value)).alias(name))


def final_count(df: DataFrame, key: str | Sequence[str], name: str = "cnt") -> DataFrame:
    """The last state of ``running_count``: one row per key. Also the streaming update form."""
    return df.groupBy(*_names(key)).agg(F.count("*").alias(name))


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
