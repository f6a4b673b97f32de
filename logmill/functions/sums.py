"""Sums of 64-bit integers that do not overflow.

A plain ``sum(bigint)`` stops the job past 2^63 and a decimal sum leaves the fast
aggregate path. Summing the high and low bits apart stays in two long buffers
and is exact for any table that fits in storage.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_BITS = 20
_MASK = (1 << LOW_BITS) - 1


def limbs(value: Column) -> tuple[Column, Column]:
    """(high, low) with ``value = high * 2^20 + low`` and ``0 <= low < 2^20``."""
    return F.shiftright(value, LOW_BITS), value.bitwiseAND(F.lit(_MASK).cast("bigint"))


def join_limbs(high: Column, low: Column) -> Column:
    """The double nearest to ``high * 2^20 + low``, for sums of limbs."""
    carried = high + F.shiftright(low, LOW_BITS)
    rest = low.bitwiseAND(F.lit(_MASK).cast("bigint"))
    return carried.cast("double") * float(1 << LOW_BITS) + rest.cast("double")


def wide_sum(value: Column) -> Column:
    """``sum(value)`` of an integer column as a double, null over no values."""
    high, low = limbs(value.cast("bigint"))
    return join_limbs(F.sum(high), F.sum(low))
