"""Union of sources and the changelog of an updating total."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.operators.chunks import reserve
from tidemark.operators.running import running

# The kinds of a changelog row.
INSERT, UPDATE_BEFORE, UPDATE_AFTER = "+I", "-U", "+U"


def union_sources(*sources: DataFrame) -> DataFrame:
    """UNION ALL by column name; all sources bounded or all streaming."""
    return reduce(DataFrame.unionByName, sources)


def total(df: DataFrame, amount: str = "amount", name: str = "total") -> DataFrame:
    """``SELECT SUM(amount)``: NULLs are ignored, no value at all gives NULL."""
    return df.agg(F.sum(amount).alias(name))


def sum_type(kind: str, scale: int) -> str:
    """The exact type of a sum over values of type ``kind``."""
    if kind in ("double", "float"):
        return f"decimal(38,{scale})"
    if kind.startswith("decimal"):
        return f"decimal(38,{kind.rstrip(')').split(',')[1]})"
    return "bigint"


def exact_amount(value: Column, kind: str, scale: int) -> Column:
    """``value`` as a number that sums exactly; never rounded."""
    exact = value.cast(sum_type(kind, scale))
    if kind not in ("double", "float"):
        return exact
    message = F.concat(F.lit(f"more than {scale} decimal places: "), value.cast("string"))
    return F.when(value.isNull() | (exact.cast(kind) == value), exact).otherwise(F.raise_error(message).cast(sum_type(kind, scale)))


@dataclass
class Totals:
    """What has been summed so far: records, values that are not missing, and the sums by name."""

    records: object = 0
    known: object = 0
    sums: Mapping[str, object] = field(default_factory=dict)

    def of(self, name: str) -> Column:
        value = self.sums.get(name, 0)
        return F.coalesce(value, F.lit(0)) if isinstance(value, Column) else F.lit(value)

    def count(self, name: str) -> Column:
        value = getattr(self, name)
        return F.coalesce(value, F.lit(0)) if isinstance(value, Column) else F.lit(value)


class Amounts:
    """How the amounts of a table are summed exactly.

    Whole numbers and decimals as they are; doubles by their bits (``functions.exact``), or, with
    ``scale``, as decimals of so many places. ``parts`` are the columns to sum, ``total`` turns sums into a total.
    """

    def __init__(self, df: DataFrame, amount: str, scale: int | None = None, places: Iterable[int] = ()) -> None:
        """``places`` are those that sums so far have bits in."""
        kind = df.schema[amount].dataType.simpleString()
        self.by_bits = kind in ("double", "float") and scale is None
        value = F.col(f"`{amount}`")
        self.parts: dict[str, Column]
        if self.by_bits:
            own = [*exact.places(df, value), *places]
            self.places = range(min(own), max(own) + 1) if own else range(0)
            self.parts = exact.parts(value, self.places)
            self.kind = kind
        else:
            self.parts = {"sum": exact_amount(value, kind, scale or 0)}
            self.kind = kind if kind in ("double", "float") else sum_type(kind, scale or 0)

    def total(self, sums: Mapping[str, Column]) -> Column:
        made = exact.total(dict(sums), self.places) if self.by_bits else sums["sum"]
        return made.cast(self.kind)


def sum_changelog(
    df: DataFrame,
    seq: str = "seq",
    amount: str = "amount",
    scale: int | None = 6,
    before: Totals | DataFrame | None = None,
    label: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """How ``SUM(amount)``, over all rows or by ``keys``, changes record by record.

    Gives ``(*keys, seq, ord, op, total)``: ``+I`` for the first record (of a key), then ``-U old`` and
    ``+U new`` (``ord`` 0 and 1) for each record that changes the total. Doubles are summed as
    decimals of ``scale`` places, and a double that has more fails the job; with ``scale=None`` any doubles are summed
    by their bits and each total is the double nearest to the exact sum. Both ways ``-U`` repeats the
    ``+U`` before it. ``before`` is what has been summed before ``df``: totals, or with ``keys`` a table ``*keys, records, known, sum``. ``label``
    names another column to give as ``seq``.
    """
    keys = list(keys)
    if isinstance(before, DataFrame) and Amounts(df, amount, scale).by_bits:
        raise ValueError("totals of doubles by key go on from a table only as decimals: give a scale")
    so_far = before if isinstance(before, Totals) else Totals()
    known_places = [int(name[4:]) for name in so_far.sums if name.startswith("limb")]
    amounts = Amounts(df, amount, scale, known_places)
    own = {f"_own_{name}": part for name, part in amounts.parts.items()}
    rows = df.select(
        *[F.col(f"`{key}`").alias(key) for key in keys], F.col(seq).alias("_order"), F.col(label or seq).alias("seq"),
        F.col(f"`{amount}`").isNotNull().cast("bigint").alias("_known"), *[part.alias(name) for name, part in own.items()],
    )
    reserve(df.select(*keys), "_order", "seq", "_known", "_n", "_k", *own)
    counts = {"_n": ("sum", F.lit(1).cast("bigint")), "_k": ("sum", F.col("_known"))}
    steps = running(rows, keys, ["_order"], {**counts, **{f"_sum_{n}": ("sum", F.col(f"_own_{n}")) for n in amounts.parts}})
    if isinstance(before, DataFrame):
        known = before.select(*[F.col(f"`{key}`").alias(f"_b_{key}") for key in keys], "records", "known", "sum")
        same = reduce(lambda a, b: a & b, [F.col(f"`{key}`").eqNullSafe(F.col(f"`_b_{key}`")) for key in keys])
        steps = steps.join(known, same, "left")
        so_far = Totals(F.col("records"), F.col("known"), {"sum": F.col("sum")})

    if amounts.by_bits:
        # The rows of a group leave one task in order; their totals, which are costly, are worked out in all.
        steps = steps.repartition(df.sparkSession.sparkContext.defaultParallelism, "seq")
    zero = F.lit(0)
    after = {n: F.coalesce(f"_sum_{n}", zero) + so_far.of(n) for n in amounts.parts}
    earlier = {n: after[n] - F.coalesce(f"_own_{n}", zero) for n in amounts.parts}
    values = F.col("_k") + so_far.count("known")
    steps = steps.select(
        *keys,
        "seq",
        (F.col("_n") + so_far.count("records") == 1).alias("_first"),
        F.when(values > 0, amounts.total(after)).alias("_new"),
        F.when(values > F.col("_known"), amounts.total(earlier)).alias("_old"),
    )
    both = F.struct("_first", "_new", "_old")

    def entry(ord_: int, op: str, value: Column) -> Column:
        return F.struct(F.lit(ord_).alias("ord"), F.lit(op).alias("op"), value.alias("total"))

    def entries(row: Column) -> Column:
        updated = F.array(entry(0, UPDATE_BEFORE, row["_old"]), entry(1, UPDATE_AFTER, row["_new"]))
        same = row["_old"].eqNullSafe(row["_new"])
        return F.when(row["_first"], F.array(entry(0, INSERT, row["_new"]))).otherwise(F.filter(updated, lambda _: ~same))

    # Totals of doubles are costly: bound here, each is worked out once for all its uses.
    return steps.select(*keys, "seq", F.inline(F.transform(F.array(both), entries)[0]))


def table_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changelog from one state of some keys to the next: ``(*keys, ord, op, *values)``.

    ``new`` has every key that changed, ``old`` those of them that were there before: ``+I`` for a key that
    was not, ``-U`` and ``+U`` for one whose values differ, nothing for one whose values are the same.
    """
    keys, values = list(keys), [c for c in new.columns if c not in keys]
    both = [F.struct(*[F.col(f"`{v}`") for v in values]).alias(name) for name in ("_old", "_new")]
    before = old.select(*[F.col(f"`{key}`").alias(f"_b_{key}") for key in keys], both[0])
    after = new.select(*keys, both[1])
    same = reduce(lambda a, b: a & b, [after[key].eqNullSafe(before[f"_b_{key}"]) for key in keys])
    joined = after.join(before, same, "left").where(F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.col("_new")))

    def entry(ord_: int, op: str, row: str) -> Column:
        return F.struct(F.lit(ord_).alias("ord"), F.lit(op).alias("op"), F.col(row).alias("row"))

    entries = F.when(F.col("_old").isNull(), F.array(entry(0, INSERT, "_new"))).otherwise(
        F.array(entry(0, UPDATE_BEFORE, "_old"), entry(1, UPDATE_AFTER, "_new"))
    )
    return joined.select(*keys, F.inline(entries)).select(*keys, "ord", "op", "row.*")
