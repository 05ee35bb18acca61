"""Packed date codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_year_code(code: Column, century: int = 20) -> Column:
    """``MMYY`` or ``MYY`` number to the first day of that month; bad codes give missing.

    Longer codes are read by their first four digits.  Plain arithmetic: no text is
    parsed per row, and ``make_date`` only sees months 1 to 12.
    """
    first_four = F.substring(code.cast("long").cast("string"), 1, 4).try_cast("int")
    digits = F.when(code <= 9999, code.cast("int")).otherwise(first_four)
    month, year = F.floor(digits / 100).cast("int"), digits % 100
    return F.when(
        month.between(1, 12), F.make_date(F.lit(century * 100) + year, month, F.lit(1))
    )


def ymd_text(text: Column) -> Column:
    """``YYYYMMDD`` text to a date; anything else gives missing."""
    return F.try_to_date(F.when(text.rlike(r"^\d{8}$"), text), "yyyyMMdd")
