"""Rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two digits, halves to even, same result in every engine."""
    return F.rint(value * 100) / 100


def round2_sql(value: str) -> str:
    """:func:`round2` as SQL text."""
    return f"rint({value} * 100) / 100"


#: Readings below this have a part whose sums are exact.
COARSE = 1 << 36
#: Sums below this are given to six digits.
SIX_DIGITS = 1 << 33


def sum_parts_sql(value: str) -> tuple[str, str]:
    """A reading as two doubles, ``high + low``. Of usual readings ``high`` is a
    multiple of 2**-16, so that its sums are exact in any order (up to 2**37), and
    ``low`` is so small that the order of its sums can't show. Readings of 2**36 and
    more are all ``low``. Both NULL for NULL and NaN."""
    usual = f"abs({value}) < {COARSE}"
    high = f"CASE WHEN {value} IS NULL OR isnan({value}) THEN NULL WHEN {usual} THEN rint({value} * 65536) / 65536 ELSE 0D END"
    low = f"CASE WHEN {value} IS NULL OR isnan({value}) THEN NULL WHEN {usual} THEN {value} - rint({value} * 65536) / 65536 ELSE {value} END"
    return high, low


def six_digits_sql(value: str) -> str:
    """A sum to six digits, so that it is what decimals would give; very large ones
    as they are."""
    return f"CASE WHEN abs({value}) < {SIX_DIGITS} THEN rint({value} * 1e6D) / 1e6D ELSE {value} END"


def mean_or_zero(total: Column, n: Column) -> Column:
    """``total / n``, and 0 where there is nothing to average."""
    return F.coalesce(F.try_divide(total.cast("double"), n.cast("double")), F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    """Readings that are NaN count as missing."""
    return F.when(~F.isnan(value), value)
