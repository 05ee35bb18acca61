"""Column-name helpers: choose, order and rename columns by pattern, upper and lower case alike."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F


def starts_with(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.lower().startswith(tuple(p.lower() for p in prefixes))]


def ends_with(df: DataFrame, *suffixes: str) -> list[str]:
    return [c for c in df.columns if c.lower().endswith(tuple(s.lower() for s in suffixes))]


def contains(df: DataFrame, *parts: str) -> list[str]:
    return [c for c in df.columns if any(p.lower() in c.lower() for p in parts)]


def between(df: DataFrame, first: str, last: str) -> list[str]:
    """The columns from ``first`` to ``last`` in table order."""
    cols = df.columns
    return cols[cols.index(first) : cols.index(last) + 1]


def pick(*groups: str | Iterable[str]) -> list[str]:
    """Join names and name lists in order, each name once."""
    names: dict[str, None] = {}
    for group in groups:
        names.update(dict.fromkeys([group] if isinstance(group, str) else group))
    return list(names)


def to_front(df: DataFrame, *groups: str | Iterable[str]) -> DataFrame:
    return df.select(*pick(*groups, df.columns))


def rename_prefix(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnsRenamed({c: new + c[len(old) :] for c in starts_with(df, old)})


def apply_to(df: DataFrame, names: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """The same column function over a set of columns, in one projection."""
    return df.withColumns({c: fn(F.col(c)) for c in names})
