"""Overlapping subgroups at several levels, in a single pass over the students.

1. Students are summed to cells: level keys x the columns the subgroups look at.
   This is the only step that sees student rows, and it combines on the map side,
   so a hot district costs one row per cell and task.
2. Each cell is repeated once for every subgroup it belongs to.
3. Grouping sets over the cells give all levels.
4. Averages, strict counts and percentages come from the final sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.fixed_values import BHN_CODES, RACE_LABELS
from acctcube.functions import in_set, is_true
from acctcube.operators.measures import Summary


@dataclass(frozen=True)
class Subgroup:
    """A label and the students it holds; a missing predicate means not a member."""

    label: str
    member: Column
    # cells whose means also count rows the averages' condition leaves out
    ungated: Column | None = None


@dataclass(frozen=True)
class Level:
    """A name and the keys that are kept; the rest are totals."""

    name: str
    keys: Sequence[str]


@dataclass(frozen=True)
class Subgroups:
    """Fixed subgroups plus, if ``code`` is given, one subgroup per value of that column."""

    fixed: Sequence[Subgroup]
    columns: Sequence[str]
    code: str | None = None
    code_labels: dict[str, str] = field(default_factory=dict)


LEVELS = [
    Level("school", ["system", "school"]),
    Level("district", ["system"]),
    Level("state", []),
]


def fixed_subgroups(el: str = "el", swd: str = "swd", loose_super: bool = False) -> list[Subgroup]:
    """The nine subgroups with a fixed predicate.

    ``loose_super`` gives the means of the Super Subgroup as the appeals file forms
    them: the tested-only condition binds to the race arm alone, so an untested
    student of another arm counts with any subject score.
    """
    race, econ = F.col("race_ethnicity"), F.col("econ_dis")
    bhn = in_set(race, BHN_CODES)
    el_, swd_ = F.col(el), F.col(swd)
    other_arms = is_true(econ == "Y") | is_true(el_ == "Y") | is_true(swd_ == "Y")
    return [
        Subgroup("All Students", F.lit(True)),
        Subgroup("Black/Hispanic/Native American", bhn),
        Subgroup("Economically Disadvantaged", econ == "Y"),
        Subgroup("English Learners", el_ == "Y"),
        Subgroup("Students with Disabilities", swd_ == "Y"),
        Subgroup("Non-Economically Disadvantaged", econ == "N"),
        Subgroup("Non-English Learners", el_ == "N"),
        Subgroup("Non-Students with Disabilities", swd_ == "N"),
        Subgroup("Super Subgroup", bhn | other_arms, other_arms if loose_super else None),
    ]


def all_subgroups(el: str = "el", swd: str = "swd", loose_super: bool = False) -> Subgroups:
    """Nine fixed subgroups and one per race code."""
    dims = ["race_ethnicity", "econ_dis", el, swd]
    return Subgroups(fixed_subgroups(el, swd, loose_super), dims, "race_ethnicity", RACE_LABELS)


def race_subgroups() -> Subgroups:
    return Subgroups([], ["race_ethnicity"], "race_ethnicity", RACE_LABELS)


def five_subgroups(el: str = "el", swd: str = "swd") -> Subgroups:
    """All students and the four the 2016 files report."""
    return Subgroups(fixed_subgroups(el, swd)[:5], ["race_ethnicity", "econ_dis", el, swd])


def label_codes(code: Column, labels: dict[str, str]) -> Column:
    """Code to label; an unknown code has no label."""
    if not labels:
        return code
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), code)


def _memberships(spec: Subgroups) -> Column:
    """The subgroups of a cell.  Codes stay codes until the end: two unknown codes are two groups."""
    label = lambda s: F.struct(F.lit("label").alias("kind"), F.lit(s.label).alias("name"))
    items = [F.when(s.member, label(s)) for s in spec.fixed]
    if spec.code:
        code = F.struct(F.lit("code").alias("kind"), F.col(spec.code).alias("name"))
        items.append(F.when(F.col(spec.code).isNotNull(), code))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def _level_name(kept: Column, keys: Sequence[str], levels: Sequence[Level]) -> Column:
    """The level whose keys are exactly the ones kept in a grouping set."""
    flags = lambda level: F.array(*[F.lit(k in level.keys) for k in keys])
    names = [F.when(kept == flags(level), F.lit(level.name)) for level in levels]
    return F.coalesce(*names) if keys else F.lit(levels[0].name)


def cell_sums(df: DataFrame, summary: Summary, keys: Sequence[str]) -> DataFrame:
    """Students summed to cells."""
    return df.groupBy(*dict.fromkeys(keys)).agg(*summary.sums(summary.row_columns()))


def subgroup_sums(
    cells: DataFrame,
    summary: Summary,
    spec: Subgroups,
    levels: Sequence[Level] = LEVELS,
    empty_totals: bool = True,
) -> DataFrame:
    """Sums per level and subgroup from cell sums.

    ``empty_totals``: the level without keys reports every fixed subgroup, also one
    that has no students.
    """
    sums = summary.column_names()
    keys = list(dict.fromkeys(k for level in levels for k in level.keys))
    long = cells.withColumn("_group", F.explode(_memberships(spec)))
    loose = [s for s in spec.fixed if s.ungated is not None]
    for s in loose:
        here = (F.col("_group.kind") == "label") & (F.col("_group.name") == s.label) & s.ungated
        long = long.withColumns(
            {gated: F.when(here, F.col(free)).otherwise(F.col(gated)) for gated, free in summary.ungated_pairs()}
        )
    long = long.select(
        *keys, F.col("_group.kind").alias("_kind"), F.col("_group.name").alias("_name"), *sums, F.lit(1).alias("_real")
    )
    total = next((x.name for x in levels if not x.keys), None)
    fill = empty_totals and total is not None and bool(spec.fixed)
    if fill:
        types = dict(long.dtypes)
        labels = F.array(*[F.lit(s.label) for s in spec.fixed])
        blank = long.sparkSession.range(0, 1, 1, 1).select(F.explode(labels).alias("_name")).select(
            *[F.lit(None).cast(types[k]).alias(k) for k in keys],
            F.lit("label").alias("_kind"),
            "_name",
            *[F.lit(0).cast(types[n]).alias(n) for n in [*sums, "_real"]],
        )
        long = long.unionByName(blank)

    group = ["_kind", "_name"]
    sets = [[F.col(k) for k in [*level.keys, *group]] for level in levels]
    kept = F.array(*[F.grouping(k) == 0 for k in keys]).alias("_kept")
    out = long.groupingSets(sets, *[F.col(k) for k in [*keys, *group]]).agg(
        *summary.sums(), F.max("_real").alias("_real"), kept
    )
    out = out.withColumn("level", _level_name(F.col("_kept"), keys, levels))
    if fill:
        # below the totals a group of blank rows only is not a group
        out = out.where((F.col("_real") == 1) | (F.col("level") == total))
    label = F.when(F.col("_kind") == "label", F.col("_name")).otherwise(
        label_codes(F.col("_name"), spec.code_labels)
    )
    return out.select("level", *keys, label.alias("subgroup"), *sums)


def subgroup_cube(
    df: DataFrame,
    summary: Summary,
    spec: Subgroups | None = None,
    levels: Sequence[Level] = LEVELS,
    empty_totals: bool = True,
    total_key: int | None = 0,
) -> DataFrame:
    """Counts and averages per level and subgroup; ``total_key`` marks keys that are totals."""
    spec = spec or all_subgroups()
    keys = [k for level in levels for k in level.keys]
    cells = cell_sums(df, summary, [*keys, *spec.columns])
    out = summary.finish(subgroup_sums(cells, summary, spec, levels, empty_totals))
    if total_key is not None:
        out = out.withColumns({k: F.coalesce(F.col(k), F.lit(total_key)) for k in dict.fromkeys(keys)})
    return out
