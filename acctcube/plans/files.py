"""The files end to end, from input tables to named aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from acctcube.fixed_values import NOT_IN_2016, SCHOOL_NAMES_IF_MISSING, SCORES
from acctcube.functions import pick, starts_with
from acctcube.operators.appeals import appeal_indicators, merge_appeals
from acctcube.operators.cohort import (
    decode_attempts,
    exclude_location,
    id_mismatch,
    stack_attempts,
    student_level,
)
from acctcube.operators.cube import LEVELS, all_subgroups, five_subgroups, subgroup_cube
from acctcube.operators.labels import label_names
from acctcube.operators.measures import (
    indicator_summary,
    missing_gender_summary,
    rates,
    rates_missing_gender,
    rates_suppressed,
    score_summary,
    suppressed_summary,
)


HIGHEST_NAMES = {"test_date": "act_testdate", **{c: f"act_{c}_highest" for c in SCORES}}
STATE_DAY_NAMES = {
    "test_date": "testdate",
    "english": "act_eng",
    "math": "act_math",
    "reading": "act_read",
    "science": "act_sci",
    "composite": "act_composite",
}


def all_attempts(
    highest: DataFrame,
    state_days: Mapping[str, DataFrame],
    matched: DataFrame,
    labels: tuple[str, str] = ("ACT highest", "Test match"),
) -> DataFrame:
    """Every score file in one table: the highest scores, the state days (label -> table)
    without make-up locations, and the matched records that belong to another id than
    the one recorded.  The label decides between records that are otherwise equal.
    """
    key = "student_id"
    parts = [(highest, {key: "unique_student_id", **HIGHEST_NAMES}, labels[0])]
    parts += [
        (exclude_location(day), {key: "state_stud_id", **STATE_DAY_NAMES}, label)
        for label, day in state_days.items()
    ]
    other = id_mismatch(matched, "unique_student_id", "usid")
    parts.append((other, {key: "usid", **HIGHEST_NAMES}, labels[1]))
    return decode_attempts(stack_attempts(parts), key)


def highest_score_cube(students: DataFrame) -> DataFrame:
    """Every level and subgroup from best scores."""
    return rates(subgroup_cube(students, score_summary()))


def post_appeals_students(students: DataFrame, appeals: DataFrame) -> DataFrame:
    return appeal_indicators(merge_appeals(students, appeals))


def post_appeals_cube(students: DataFrame, loose_super: bool = False) -> DataFrame:
    """Every level and subgroup after appeals, from ``post_appeals_students``."""
    spec = all_subgroups(loose_super=loose_super)
    return rates(subgroup_cube(students, indicator_summary(keep_ungated=loose_super), spec))


def student_file(students: DataFrame) -> DataFrame:
    """The student columns that are given out, with names and the other test where there are any."""
    optional = [c for c in ("last_name", "first_name", "sat_total") if c in students.columns]
    return students.select(
        "system",
        "school",
        F.col("student_key").alias("state_stud_id"),
        *pick(optional, "gender", SCORES, starts_with(students, "n_cr_")),
    )


def base_file(cohort: DataFrame, attempts: DataFrame, appeals: DataFrame, school_names: DataFrame) -> DataFrame:
    """Attempts and cohort to the named base table."""
    students = post_appeals_students(student_level(cohort, attempts), appeals)
    return label_names(post_appeals_cube(students), school_names)


def subgroups_2016(students: DataFrame, el: str = "el", swd: str = "swd") -> DataFrame:
    """School and district rows of five subgroups, percentages only for groups of 30 or more."""
    cube = subgroup_cube(students, suppressed_summary(), five_subgroups(el, swd), LEVELS[:2])
    return rates_suppressed(cube)


def base_file_2016(students: DataFrame, school_names: DataFrame, el: str = "el", swd: str = "swd") -> DataFrame:
    """The 2016 rows with names; there is no state row."""
    overrides = {k: v for k, v in SCHOOL_NAMES_IF_MISSING.items() if k not in NOT_IN_2016}
    return label_names(subgroups_2016(students, el, swd), school_names, overrides, state_name=None)


def totals_2016(students: DataFrame, *keys: str) -> DataFrame:
    """All students per group (district, school or state), with a missing-gender column."""
    rows = rates_missing_gender(missing_gender_summary().by(students, *keys))
    return rows.withColumn("subgroup", F.lit("All Students"))
