"""Strict number parsing and event-time conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strict_number(text: Column, sql_type: str, what: str) -> Column:
    """Parse a number; malformed text fails the job whatever the ANSI setting is."""
    parsed = text.try_cast(sql_type)
    message = F.concat(F.lit(f"malformed {what}: "), F.coalesce(text, F.lit("<null>")))
    return F.coalesce(parsed, F.raise_error(message).cast(sql_type))


def parse_numbers(
    df: DataFrame, columns: dict[str, tuple[Column, str]], on_error: str = "fail"
) -> DataFrame:
    """Add number columns ``{name: (text, sql_type)}``.

    ``on_error="fail"`` raises on malformed text, ``"drop"`` leaves the row out.
    """
    if on_error == "fail":
        return df.withColumns(
            {name: strict_number(text, kind, name) for name, (text, kind) in columns.items()}
        )
    if on_error != "drop":
        raise ValueError(f"on_error must be 'fail' or 'drop', not {on_error!r}")
    parsed = df.withColumns({name: text.try_cast(kind) for name, (text, kind) in columns.items()})
    return parsed.dropna(subset=list(columns))


def to_millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp column."""
    return F.unix_millis(ts.cast("timestamp"))


def to_cents(amount: Column) -> Column:
    """Money as whole cents, so that sums do not depend on their order."""
    return F.round(amount * 100).cast("bigint")


def floor_to(value: Column, width: int) -> Column:
    """Largest multiple of ``width`` that is not above ``value`` (both ``bigint``)."""
    return value - F.pmod(value, F.lit(width).cast("bigint"))
