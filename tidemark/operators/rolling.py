"""Rolling aggregates over a time horizon that have no inverse, such as a maximum.

A count or sum can drop what leaves the horizon by subtracting it; a maximum can not. Time is cut into blocks
one horizon long. What is inside the horizon of a record then is the beginning of its own block, up to
the record, and the end of the block before: a running aggregate forward over the one and backward
over the other, each of which can be cut into chunks like any (``operators.running``). Every row is
worked on twice, however many lie in one horizon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import floor_to
from tidemark.operators.chunks import reserve
from tidemark.operators.running import running

_AHEAD = 1 << 62
_OF_TWO = {"max": F.greatest, "min": F.least}


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    kind: str,
    value: Column,
    horizon_ms: int,
    name: str,
    ts_ms: str = "ts_ms",
    seq: str = "seq",
) -> DataFrame:
    """Add ``name``: the ``max`` or ``min`` of ``value`` over the key's records less than ``horizon_ms``
    before each record, itself and those before it in ``(ts_ms, seq)`` included.

    ``ts_ms`` and ``seq`` are whole numbers, none missing, and their pair is unique for each key. Missing
    values count nothing; a record with none in its horizon gets a missing one.
    """
    reserve(df, "_block", "_down", "_tie", "_v", "_ahead", "_behind", "_probe", name)
    keys = [*keys, "_block"]
    rows = df.withColumns({"_block": floor_to(F.col(ts_ms), horizon_ms), "_v": value})
    ahead = running(rows, keys, [ts_ms, seq], {"_ahead": (kind, F.col("_v"))})
    # Backward along the time at which rows leave: a row of the block before is inside the horizon of
    # a record as long as it leaves after the record's time, so it comes before it.
    probes = ahead.withColumns({"_probe": F.lit(True), "_down": -F.col(ts_ms), "_tie": F.col(seq) - F.lit(_AHEAD)})
    leaving = rows.select(
        *[F.col(f"`{key}`") for key in keys[:-1]],
        (F.col("_block") + horizon_ms).alias("_block"),
        F.lit(False).alias("_probe"),
        (-(F.col(ts_ms) + horizon_ms)).alias("_down"),
        F.col(seq).cast("bigint").alias("_tie"),
        "_v",
    )
    both = probes.unionByName(leaving, allowMissingColumns=True)
    behind = running(both, keys, ["_down", "_tie"], {"_behind": (kind, F.when(~F.col("_probe"), F.col("_v")))})
    return behind.where("_probe").select(*df.columns, _OF_TWO[kind]("_ahead", "_behind").alias(name))
