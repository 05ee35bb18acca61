"""Names and labels for aggregate rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.fixed_values import (
    ALL_SCHOOLS,
    EXTERNAL_COLUMNS,
    EXTERNAL_SUBGROUPS,
    SCHOOL_NAMES_FORCED,
    SCHOOL_NAMES_IF_MISSING,
    STATE_NAME,
)
from acctcube.functions import if_else, to_front
from acctcube.operators.carry import carry_forward
from acctcube.operators.joins import left_join

Overrides = Mapping[tuple[int, int], str]


def relabel(col: Column, labels: Mapping[str, str]) -> Column:
    """Replace the values that have a new label; keep the rest."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def relabel_subgroups(df: DataFrame, labels: Mapping[str, str] = EXTERNAL_SUBGROUPS) -> DataFrame:
    return df.withColumn("subgroup", relabel(F.col("subgroup"), labels))


def external_layout(df: DataFrame) -> DataFrame:
    """Our aggregate under the external file's column and subgroup names."""
    return relabel_subgroups(df).withColumnsRenamed(
        {ours: theirs for ours, theirs in EXTERNAL_COLUMNS.items() if ours in df.columns}
    )


def _at(system: int, school: int) -> Column:
    return (F.col("system") == system) & (F.col("school") == school)


def names_if_missing(name: Column, overrides: Overrides) -> Column:
    """Listed names, only where there is none."""
    if not overrides:
        return name
    chain = reduce(lambda acc, kv: acc.when(_at(*kv[0]), kv[1]), overrides.items(), F)
    return F.coalesce(name, chain)


def names_forced(name: Column, overrides: Overrides) -> Column:
    """Listed names whatever is there; a comparison with a missing key blanks the name."""
    return reduce(lambda acc, kv: if_else(_at(*kv[0]), kv[1], acc), overrides.items(), name)


def label_names(
    base: DataFrame,
    crosswalk: DataFrame,
    overrides: Overrides = SCHOOL_NAMES_IF_MISSING,
    all_schools: str = ALL_SCHOOLS,
    state_name: str | None = STATE_NAME,
) -> DataFrame:
    """Attach names to state, district and school rows (key 0 is a total).

    A district name that is still missing is carried forward from the row before
    in system, school, subgroup order.
    """
    named = left_join(base, crosswalk, ["system", "school"])
    school_name = F.when(F.col("school_name").isNull() & (F.col("school") == 0), all_schools).otherwise(
        F.col("school_name")
    )
    named = named.withColumn("school_name", school_name)
    named = named.withColumn("school_name", names_if_missing(F.col("school_name"), overrides))
    named = carry_forward(named, ["system", "school", "subgroup"], ["system_name"])
    if state_name is not None:
        named = named.withColumn(
            "system_name", if_else(F.col("system") == 0, state_name, F.col("system_name"))
        )
    return to_front(named, ["system", "system_name", "school", "school_name", "subgroup"])


def label_names_forced(
    df: DataFrame, crosswalk: DataFrame, overrides: Overrides = SCHOOL_NAMES_FORCED
) -> DataFrame:
    """Attach names to school rows, with listed names taking precedence."""
    named = left_join(df, crosswalk, ["system", "school"])
    return named.withColumn("school_name", names_forced(F.col("school_name"), overrides))
