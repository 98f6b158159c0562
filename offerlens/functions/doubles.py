"""Doubles taken apart: exponent, mantissa, and a whole number in the order of the values.

All by arithmetic that is exact: scaling by powers of two, comparison, and whole numbers.
"""

import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the format: least exponent of a normal number, bits after the point.
LEAST, FRACTION = -1022, 52
INFINITE = 0x7FF << FRACTION


def _two_to(power: Column) -> Column:
    return F.pow(F.lit(2.0), power)


def exponent(value: Column) -> Column:
    """The exponent of a finite number, ``LEAST`` for zero and the numbers below the normal ones."""
    size = F.greatest(F.abs(value), F.lit(2.0**LEAST))
    near = F.floor(F.log2(size)).cast("int")  # one off at most, next to powers of two
    near = F.greatest(F.least(near, F.lit(1023)), F.lit(LEAST))
    too_high = (size < _two_to(near)).cast("int")
    too_low = ((near < 1023) & (size >= _two_to(near + 1))).cast("int")
    return near - too_high + too_low


def mantissa(value: Column, power: Column) -> Column:
    """The whole number below 2^53 that times 2^(``power`` - 52) is the size of a finite number."""
    # 2^-power may be below the normal numbers, but is exact; 2^(52 - power) could be infinite.
    return (F.abs(value) * _two_to(-power) * F.lit(2.0**FRACTION)).cast("long")


def order_key(value: Column) -> Column:
    """A whole number in the order of the values, missing for NaN and missing ones; zeros are equal."""
    power = exponent(value)
    whole = mantissa(value, power)
    # A mantissa below 2^52 is that of a number below the normal ones.
    raised = (power + (1 - LEAST)).cast("long") * F.lit(1 << FRACTION) + whole - F.lit(1 << FRACTION)
    bits = F.when(F.abs(value) == F.lit(float("inf")), F.lit(INFINITE)).when(whole < (1 << FRACTION), whole).otherwise(raised)
    return F.when(value.isNull() | F.isnan(value), F.lit(None)).when(value < 0, -bits).otherwise(bits)


def of_order_key(key: int) -> float:
    """The number with this key."""
    size = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -size if key < 0 else size
