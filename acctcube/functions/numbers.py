"""Percentages, rounding and text <-> number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole; a zero whole gives a missing percentage."""
    return F.try_divide(F.lit(100.0) * part, whole)


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def round_even(x: Column, digits: int = 0) -> Column:
    """Round to the nearest whole number or tenth, exact ties to even.

    The stored binary value decides, not its decimal print-out: 247/20 prints as
    12.35 but is stored a little lower, so one digit gives 12.3.  (``bround``
    rounds the print-out and gives 12.4.)
    """
    x = x.cast("double")
    if digits == 0:
        return F.rint(x)
    if digits != 1:
        raise ValueError("digits must be 0 or 1")
    whole = F.floor(x)
    # ten times the fraction as a rounded sum and its exact error: at what looks like a tie
    # the sign of the error tells on which side the stored value lies
    a, b = (x - whole) * 8.0, (x - whole) * 2.0
    s = a + b
    error = (a - (s - (s - a))) + (b - (s - a))
    tie = s - F.floor(s) == 0.5
    tenths = F.when(tie & (error > 0), F.floor(s) + 1.0).when(tie & (error < 0), F.floor(s) + 0.0).otherwise(F.rint(s))
    return (whole * 10.0 + tenths) / 10.0


def round_up(x: Column, digits: int = 0) -> Column:
    """Round to the nearest multiple of 10**-digits, ties away from zero."""
    return F.round(x.cast("double"), digits)


def to_number(text: Column, dtype: str = "double") -> Column:
    """Text to number; anything that is not a plain number becomes missing.

    Integer targets keep all digits of whole-number text and truncate a fraction.
    """
    plain = F.when(text.rlike(_NUMBER), F.trim(text))
    if dtype in ("double", "float"):
        return plain.try_cast(dtype)
    return F.coalesce(plain.try_cast(dtype), plain.try_cast("double").try_cast(dtype))


def number_text(x: Column) -> Column:
    """Number to text without a trailing ``.0``."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")
