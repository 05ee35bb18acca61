"""Approved appeals over the student table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.fixed_values import (
    BENCHMARKS,
    HIGH_COMPOSITE,
    HIGH_TOTAL,
    LOW_COMPOSITE,
    LOW_TOTAL,
    SUBJECTS,
)
from acctcube.functions import flag, if_else, pick, to_number
from acctcube.functions.columns import contains, ends_with
from acctcube.operators.cohort import benchmark_flags
from acctcube.operators.joins import attach


def approved_appeals(
    tracker: DataFrame,
    student: str = "student_id",
    status: str = "status",
    approved: str = "Approved",
    key: str = "student_key",
) -> DataFrame:
    """Approved rows with an id: key, appealed scores and the other test's columns as numbers.

    The tracker is a spreadsheet: numbers may be text such as ``24.0``, and headers come in any
    case; the result's are lower-case.
    """
    kept = tracker.where(F.col(student).isNotNull() & (F.col(status) == approved))
    names = pick(ends_with(tracker, "_highest"), contains(tracker, "sat"))
    return kept.select(
        to_number(F.col(student).cast("string"), "bigint").alias(key),
        *[to_number(F.col(c).cast("string"), "int").alias(c.lower()) for c in names],
    )


def merge_appeals(
    students: DataFrame,
    appeals: DataFrame,
    key: str = "student_key",
    subjects: Sequence[str] = SUBJECTS,
    refill: bool = True,
    keys_present: bool = False,
) -> DataFrame:
    """Override scores by appealed ones.

    The appeal is taken where the composite is missing or lower.  All subject
    decisions read the composite as it was before, so one projection does it.
    With ``refill`` a subject that is still missing takes the appealed score;
    without it a subject is lost where the composite was missing.  Missing keys match.
    """
    joined = attach(students, appeals.withColumnRenamed(key, "_appealed"), key, "_appealed", keys_present)
    old, new = F.col("composite"), F.col("act_composite_highest")
    take = new.isNotNull() & (old.isNull() | (new > old))

    def subject(name: str) -> Column:
        ours, theirs = F.col(name), F.col(f"act_{name}_highest")
        if refill:
            return F.coalesce(F.when(take, theirs).otherwise(ours), theirs)
        return F.when(new.isNull(), ours).otherwise(if_else(new > old, theirs, ours))

    return joined.withColumns(
        {**{s: subject(s) for s in subjects}, "composite": F.when(take, new).otherwise(old)}
    )


def appeal_indicators(df: DataFrame, other_total: str = "sat_total", gender: str = "gender") -> DataFrame:
    """0/1 columns per student; the other test's total stands in for a missing composite."""
    composite, total = F.col("composite"), F.col(other_total)
    tested = F.greatest(flag(composite.isNotNull()), flag(total.isNotNull()))
    high = flag(F.coalesce(composite >= HIGH_COMPOSITE, total >= HIGH_TOTAL, F.lit(False)))
    low = flag(F.coalesce(composite < LOW_COMPOSITE, total < LOW_TOTAL, F.lit(False)))
    female, male = F.col(gender) == "F", F.col(gender) == "M"
    return benchmark_flags(df, BENCHMARKS, "ungated").withColumns(
        {
            "enrolled": F.lit(1),
            "tested": tested,
            "valid_tests": tested,
            "valid_tests_female": flag((tested == 1) & female),
            "valid_tests_male": flag((tested == 1) & male),
            "n_21_or_higher": high,
            "n_below_19": low,
            "n_female_21_or_higher": flag(female & (high == 1)),
            "n_male_21_or_higher": flag(male & (high == 1)),
            "n_female_below_19": flag(female & (low == 1)),
            "n_male_below_19": flag(male & (low == 1)),
        }
    )
