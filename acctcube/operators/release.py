"""Suppress and shape tables for publication."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.fixed_values import ACCOUNTABILITY_SUBGROUPS, RELEASE_COLUMNS, STATE_NAME
from acctcube.functions import if_else, in_set, number_text, pick, ratio, starts_with
from acctcube.operators.joins import left_join
from acctcube.operators.labels import label_names_forced, relabel

EXTREME, SMALL = "**", "*"


def suppress_value(value: Column, tests: Column, low: float, high: float, minimum: int) -> Column:
    """Text of the value, ``**`` outside the bounds, ``*`` (which wins) under the minimum."""
    shown = if_else((value > high) | (value < low), EXTREME, number_text(value))
    return if_else(tests < minimum, SMALL, shown)


def suppress_count(count: Column, tests: Column, low: float, high: float, minimum: int) -> Column:
    """The same on the count's share of the tests."""
    share = ratio(count, tests)
    shown = if_else((share < low) | (share > high), EXTREME, number_text(count))
    return if_else(tests < minimum, SMALL, shown)


@dataclass(frozen=True)
class Suppression:
    """Bounds in percent and the smallest group shown.

    Means are held against the same bounds as percentages.  ``rate`` also
    suppresses the participation rate, ``counts`` the Number columns.
    """

    low: float = 1
    high: float = 99
    minimum: int = 10
    rate: bool = False
    counts: bool = False


def suppress(df: DataFrame, rule: Suppression, tests: str = "Valid Tests") -> DataFrame:
    names = pick(starts_with(df, "Average"), starts_with(df, "Percent"), ["Participation Rate"] if rule.rate else [])
    n = F.col(f"`{tests}`")
    cols = {c: suppress_value(F.col(f"`{c}`"), n, rule.low, rule.high, rule.minimum) for c in names}
    if rule.counts:
        cols |= {
            c: suppress_count(F.col(f"`{c}`"), n, rule.low / 100, rule.high / 100, rule.minimum)
            for c in starts_with(df, "Number")
        }
    return df.withColumns(cols)


def release_columns(df: DataFrame, keys: dict[str, Column], numbers: bool = False) -> DataFrame:
    """Published names: key columns, then the measures of the external layout."""
    names = {
        old: new for old, new in RELEASE_COLUMNS.items() if numbers or not new.startswith("Number")
    }
    return df.select(*[c.alias(n) for n, c in keys.items()], *[F.col(old).alias(new) for old, new in names.items()])


def _accountability(df: DataFrame, subgroups: Sequence[str]) -> DataFrame:
    return df.where(in_set(F.col("Subgroup"), subgroups))


def release_state(external: DataFrame, rule: Suppression = Suppression(), state_name: str = STATE_NAME) -> DataFrame:
    """State rows, all subgroups."""
    keys = {
        "District": F.lit(0),
        "District Name": F.lit(state_name),
        "Subgroup": relabel(F.col("subgroup"), {"HPI": "Hawaiian or Pacific Islander"}),
    }
    return suppress(release_columns(external, keys), rule)


def release_district(
    external: DataFrame,
    names: DataFrame,
    rule: Suppression = Suppression(counts=True),
    subgroups: Sequence[str] = ACCOUNTABILITY_SUBGROUPS,
    district: int | None = None,
) -> DataFrame:
    """District rows of the accountability subgroups, optionally of one district."""
    keys = {"District": F.col("system"), "District Name": F.col("system_name"), "Subgroup": F.col("subgroup")}
    named = left_join(external, names, "system")
    out = _accountability(suppress(release_columns(named, keys, numbers=True), rule), subgroups)
    return out if district is None else out.where(F.col("District") == district)


def release_school(
    external: DataFrame,
    names: DataFrame,
    rule: Suppression = Suppression(low=5, high=95),
    subgroups: Sequence[str] = ACCOUNTABILITY_SUBGROUPS,
    **overrides,
) -> DataFrame:
    """School rows of the accountability subgroups, with forced school names."""
    keys = {
        "District": F.col("system"),
        "District Name": F.col("system_name"),
        "School": F.col("school"),
        "School Name": F.col("school_name"),
        "Subgroup": F.col("subgroup"),
    }
    named = label_names_forced(external, names, **overrides)
    return _accountability(suppress(release_columns(named, keys), rule), subgroups)
