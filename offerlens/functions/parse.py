"""Dirty text to typed columns, as native expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.schema import SENTINEL

# The characters Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Unit factors.
MHZ_PER_GHZ = 1000.0
GB_PER_MB = 0.001

# What Python's float() accepts between white space. Spark's own cast also takes
# "1d", "1f" and hexadecimal, which must count as bad cells.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = (
    rf"[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))"
)
# float() leaves the four separator controls alone, unlike strip().
_FLOAT_SPACE = "".join(c for c in WHITESPACE if not "\x1c" <= c <= "\x1f")
_FLOAT = rf"^[{_FLOAT_SPACE}]*({_NUMBER})[{_FLOAT_SPACE}]*$"


def trim(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def _without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def is_py_float(text: Column) -> Column:
    return text.rlike(_FLOAT)


def py_float(text: Column) -> Column:
    """``float(text)``; NULL for NaN and for text that Python would reject."""
    # No match gives "", which the cast turns into NULL.
    number = _without(F.regexp_extract(text, _FLOAT, 1), "_").try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def sentinel_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(SENTINEL))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def _price_digits(text: Column) -> Column:
    return _without(_without(text, "."), ",")


def _first_unit_removed(lowered: Column, units: list[str]) -> Column:
    # Removing a unit that is not there changes nothing, so the last one needs no condition.
    return reduce(
        lambda rest, unit: F.when(lowered.contains(unit), _without(lowered, unit)).otherwise(rest),
        reversed(units[:-1]),
        _without(lowered, units[-1]),
    )


def price_usd(text: Column) -> Column:
    """Whole dollars: every dot and comma is a separator, so ``1,299.99`` is 129999."""
    return py_float(_price_digits(text))


def clock_mhz(text: Column) -> Column:
    """Megahertz; a bare number is taken as megahertz."""
    lowered = F.lower(text)
    factor = F.when(lowered.contains("ghz"), MHZ_PER_GHZ).otherwise(1.0)
    return py_float(_first_unit_removed(lowered, ["ghz", "mhz"])) * factor


def ram_gb(text: Column) -> Column:
    """Decimal gigabytes; a bare number is taken as gigabytes."""
    lowered = F.lower(text)
    factor = F.when(lowered.contains("mb"), GB_PER_MB).otherwise(1.0)
    return py_float(_first_unit_removed(lowered, ["mb", "gb"])) * factor


def _rejected(number_text: Column, whole_text: Column) -> Column:
    """The sentinel is no bad cell, but only where it is the whole text."""
    return F.coalesce(~is_py_float(number_text) & (whole_text != SENTINEL), F.lit(False))


def bad_price(text: Column) -> Column:
    """True where the price text would make the cleaning of its batch fail."""
    digits = _price_digits(text)
    return _rejected(digits, digits)


def bad_clock(text: Column) -> Column:
    lowered = F.lower(text)
    return _rejected(_first_unit_removed(lowered, ["ghz", "mhz"]), lowered)


def bad_ram(text: Column) -> Column:
    lowered = F.lower(text)
    return _rejected(_first_unit_removed(lowered, ["mb", "gb"]), lowered)
