"""Missing-value rules, written out instead of left to the engine."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, functions as F


def if_else(cond: Column, yes: Any, no: Any) -> Column:
    """Three-valued conditional: a missing condition gives a missing result."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(cond.isNull(), F.lit(None)).when(cond, as_col(yes)).otherwise(as_col(no))


def in_set(col: Column, values: Iterable[Any]) -> Column:
    """Membership where a missing value is simply not a member."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def is_true(cond: Column) -> Column:
    """True only where the condition is known to hold."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """1 / 0 / missing."""
    return cond.cast("int")


def nan_to_null(col: Column) -> Column:
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def differs(a: Column, b: Column) -> Column:
    """Inequality where two missing values are equal."""
    return ~a.eqNullSafe(b)
