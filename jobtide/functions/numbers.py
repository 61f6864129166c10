"""Number parsing, rounding and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number or an infinity. The JVM parser alone would also take type
# suffixes such as "1d" and hexadecimal notation.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def to_number(text: Column) -> Column:
    """Text as DOUBLE, NULL where it is no number (decimal commas included).

    Only text that does not end in a digit, or contains an x, pays for the pattern.
    """
    ends_in_digit = F.substring(text, -1, 1).between("0", "9")
    hexadecimal = text.contains("x") | text.contains("X")
    plain = ends_in_digit & ~hexadecimal
    return F.when(plain | text.rlike(_NUMBER), text.try_cast("double"))


def round_half_even(value: Column, digits: int = 1) -> Column:
    """Round with halves going to the even digit; ``F.round`` rounds them up."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def percent_change(base: Column, target: Column) -> Column:
    """Change from ``base`` to ``target`` in percent of ``|base|``; a zero base counts as 1."""
    size = F.coalesce(F.nullif(F.abs(base), F.lit(0)), F.lit(1))
    return round_half_even((target - base) / size * 100)


def is_missing(value: Column, is_float: bool = False) -> Column:
    """NULL, or NaN in a floating-point column."""
    return value.isNull() | F.isnan(value) if is_float else value.isNull()


def is_gain(balance: Column) -> Column:
    """Sign class of a balance: true for zero and above."""
    return balance >= 0


def signed_percent(value: Column) -> Column:
    """``+12.3%``."""
    return F.format_string("%+.1f%%", value)


def signed_thousands(value: Column) -> Column:
    """``+1,234`` for gains, ``-1,234`` for losses, ``0``."""
    return F.concat(F.when(value > 0, "+").otherwise(""), F.format_number(value, 0))
