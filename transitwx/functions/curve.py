"""A space-filling order: rows near in several columns at once come near in one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_of(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the rising ``cuts`` are at or below the value, by halving; null counts as none."""

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(cuts[middle]), pick(middle + 1, high)).otherwise(pick(low, middle))

    return F.when(value.isNull(), 0).otherwise(pick(0, len(cuts)))


def interleave(numbers: Sequence[Column], bits: int) -> Column:
    """One number from the low ``bits`` of each, their bits in turn (Morton order)."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for place, number in enumerate(reversed(numbers)):
            one = F.shiftright(number.cast("long"), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(numbers) + place))
    return key
