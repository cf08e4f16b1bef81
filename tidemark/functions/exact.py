"""Exact sums of doubles: whole-number limbs that add up in any order, rounded once at the end.

A double is a whole number of 53 bits times a power of two. Cut along fixed places every 20 bits it is
a few small whole numbers, its *limbs*; limbs of one place are summed as bigint, which is exact in any order
and in any chunks. Only then is the total turned into the nearest double. All of it is column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20
# The lowest place a double can have a bit in.
LOWEST = -1074
SPECIAL = {"nan": float("nan"), "more": float("inf"), "less": float("-inf")}


def _scaled(value: Column, exponent: int) -> Column:
    """``value`` times a power of two, exact unless it is beyond the range of doubles."""
    half = exponent // 2
    return value * F.lit(math.ldexp(1.0, half)) * F.lit(math.ldexp(1.0, exponent - half))


def limb(value: Column, place: int) -> Column:
    """The bits of a double from ``BITS * place`` on, ``BITS`` of them, with its sign; 0 if not finite."""
    there = _scaled(value, -BITS * place)
    # So far above the place, a double has no bits in it.
    near = F.abs(there) < F.lit(math.ldexp(1.0, 100))
    return F.when(near, F.when(near, there) % F.lit(float(1 << BITS))).otherwise(F.lit(0.0)).cast("bigint")


def places(df: DataFrame, value: Column) -> range:
    """The places from the lowest to the highest in which any value has bits."""
    size = F.abs(value.cast("double"))
    size = F.when((size > 0) & (size < F.lit(float("inf"))), size)
    least, most = df.agg(F.min(size), F.max(size)).first()
    if least is None:
        return range(0)
    low = max(LOWEST, math.frexp(least)[1] - 53)
    where = range(low // BITS, (math.frexp(most)[1] - 1) // BITS + 1)
    # The least value need not use all of its 53 bits.
    held = df.agg(*[F.max(limb(value.cast("double"), place) != 0) for place in where]).first()
    used = [place for place, some in zip(where, held, strict=True) if some]
    return range(used[0], used[-1] + 1)


def parts(value: Column, where: range) -> dict[str, Column]:
    """What is to be summed, by name: limbs, and how often a value is not finite."""
    value = value.cast("double")
    limbs = {f"limb{place}": limb(value, place) for place in where}
    odd = {name: value == F.lit(special) for name, special in SPECIAL.items()}
    counts = {name: F.coalesce(hit.cast("bigint"), F.lit(0)) for name, hit in odd.items()}
    return {name: F.coalesce(part, F.lit(0)).cast("bigint") for name, part in {**limbs, **counts}.items()}


def places_of(sums: dict) -> list[int]:
    """The places that summed parts have bits in."""
    return [int(name[4:]) for name in sums if name.startswith("limb")]


def number(text: str) -> int | Decimal:
    """A sum that was kept as text."""
    return int(text) if text.lstrip("-").isdigit() else Decimal(text)


def carried(sums: dict) -> dict:
    """The same sums with limbs of ``BITS`` bits again, so that they never outgrow a bigint."""
    where = places_of(sums)
    if not where:
        return sums
    low = min(where)
    whole = sum(sums[f"limb{place}"] << (BITS * (place - low)) for place in where)
    limbs, left, place = {}, abs(whole), low
    while left:
        limbs[f"limb{place}"] = (left & ((1 << BITS) - 1)) * (1 if whole > 0 else -1)
        left, place = left >> BITS, place + 1
    return {**{name: value for name, value in sums.items() if not name.startswith("limb")}, **limbs}


def _digits(limbs: Column) -> Column:
    """Limbs of any size, lowest first, as digits from 0 on and what is left above them."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def add(done: Column, limb: Column) -> Column:
        sum_ = limb + done["carry"]
        digit = F.array(sum_.bitwiseAND(F.lit((1 << BITS) - 1)))
        return F.struct(F.shiftright(sum_, BITS).alias("carry"), F.concat(done["digits"], digit).alias("digits"))

    return F.aggregate(limbs, start, add)


def _bind(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _in_one(limbs: Sequence[Column], lowest: int) -> tuple[Column, Column] | None:
    """Whether limbs, lowest first, make one bigint, and the double nearest to it; None if they never do."""
    if not 0 < len(limbs) <= 3 or not LOWEST <= BITS * lowest <= 900:
        return None
    most = [F.lit(1 << (60 - BITS * i)) for i in range(len(limbs))]
    fits = reduce(lambda a, b: a & b, [(limb > -top) & (limb < top) for limb, top in zip(limbs, most, strict=True)])
    whole = reduce(lambda a, b: a + b, [F.shiftleft(limb, BITS * i) for i, limb in enumerate(limbs)])
    return fits, _scaled(whole.cast("double"), BITS * lowest)


def total(sums: dict[str, Column], where: Sequence[int]) -> Column:
    """The double nearest to the sum of which ``sums`` are the summed parts."""
    zero = F.lit(0).cast("bigint")
    one = _in_one([sums[f"limb{place}"] for place in where], where[0] if len(where) else 0)
    # Three places below for the digits that are rounded, and room above for the carry.
    limbs = F.array(*[zero] * 3, *[sums[f"limb{place}"] for place in where], *[zero] * 4)
    lowest = (where[0] if len(where) else 0) - 3

    def nearest(digits: Column, sign: Column) -> Column:
        def from_top(top: Column) -> Column:
            """``top`` is the number, from 1, of the first digit that is not 0."""
            head = F.element_at(digits, top)
            rest = sum(
                (F.element_at(digits, top - i) * F.lit(1 << (60 - BITS * i)) for i in range(1, 4)), start=zero
            )
            used = F.length(F.bin(head))
            kept = F.call_function("shiftleft", head, F.lit(60) - used).bitwiseOR(F.call_function("shiftright", rest, used))
            lost = rest != F.call_function("shiftleft", F.call_function("shiftright", rest, used), used)
            below = F.exists(F.slice(digits, F.lit(1), top - 4), lambda digit: digit != 0)
            # 60 bits, the last set if any below is: rounding to 53 bits is then right.
            exact = kept.bitwiseOR((lost | below).cast("bigint")).cast("double")
            exponent = used - 60 + BITS * (top - 1 + lowest)
            half = F.floor(exponent / 2)
            return sign * exact * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)

        top = F.size(digits) + 1 - F.array_position(F.transform(F.reverse(digits), lambda digit: digit != 0), True)
        any_ = F.exists(digits, lambda digit: digit != 0)
        return F.when(any_, _bind(top.cast("int"), from_top)).otherwise(F.lit(0.0))

    def signed(made: Column) -> Column:
        down = _digits(F.transform(limbs, lambda limb: -limb))["digits"]
        return F.when(made["carry"] < 0, _bind(down, lambda d: nearest(d, F.lit(-1.0)))).otherwise(
            _bind(made["digits"], lambda d: nearest(d, F.lit(1.0)))
        )

    more, less = sums["more"] > 0, sums["less"] > 0
    finite = _bind(_digits(limbs), signed)
    if one is not None:
        # Digits are costly: most sums need none.
        finite = F.when(one[0], one[1]).otherwise(finite)
    return (
        F.when((sums["nan"] > 0) | (more & less), F.lit(float("nan")))
        .when(more, F.lit(float("inf")))
        .when(less, F.lit(float("-inf")))
        .otherwise(finite)
    )
