"""Conditional emission over a rolling time horizon (a window that never closes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.chunks import reserve
from tidemark.operators.running import running

# Fixed values of the documented job: the word that fires and its horizon.
FIRING_WORD = "1"
HORIZON_MS = 30_000

_LEAVES = -(1 << 62)


def conditional_emit(
    df: DataFrame,
    keys: str | Sequence[str],
    predicate: Column,
    ts_ms: str = "ts_ms",
    seq: str = "seq",
    horizon_ms: int = HORIZON_MS,
    name: str = "cnt",
    weight: str | None = None,
) -> DataFrame:
    """Emit a key's second and later records that satisfy ``predicate``.

    ``name`` counts the key's records, this one included, that came so far and lie
    less than ``horizon_ms`` back. ``ts_ms`` does not decrease along ``seq``.

    Each record enters the count at ``ts_ms`` and leaves it at ``ts_ms + horizon_ms``,
    so the rolling count is a running sum of +1 and -1 steps; unlike a range frame
    that can be cut anywhere, however many records fall inside one horizon.
    A row stands for ``weight`` records of one time, if that column is given.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    reserve(df, "_at", "_nth", "_step", "_seen")
    records = F.col(weight) if weight else F.lit(1).cast("bigint")
    enters = F.struct(F.col(ts_ms).alias("_at"), F.col(seq).alias("_nth"), records.alias("_step"))
    # At one instant records leave before new ones enter.
    leaves = F.struct(
        (F.col(ts_ms) + horizon_ms).alias("_at"),
        (F.col(seq) + F.lit(_LEAVES)).alias("_nth"),
        (-records).alias("_step"),
    )
    entering = F.col("_step") > 0
    steps = df.select("*", F.inline(F.array(enters, leaves)))
    # The leaving copy needs no more than its keys.
    steps = steps.withColumns(
        {c: F.when(entering, F.col(c)) for c in df.columns if c not in keys}
    )
    counted = running(
        steps,
        keys,
        ["_at", "_nth"],
        {name: ("sum", F.col("_step")), "_seen": ("sum", F.greatest("_step", F.lit(0)))},
    )
    return counted.where(entering & (F.col("_seen") >= 2) & predicate).select(*df.columns, name)
