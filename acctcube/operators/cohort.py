"""Student level: cohort, best scores, benchmark flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.fixed_values import BENCHMARKS, SCORES
from acctcube.functions import differs, flag, if_else, is_true, month_year_code, to_number
from acctcube.operators.best import SCORE_FIRST, SUBJECT_FIRST, Order, best_record, first_nonmissing
from acctcube.operators.joins import attach


def graduates(cohort: DataFrame, included: str = "included_in_cohort", completion: str = "completion_type") -> DataFrame:
    """Included in the cohort with a regular completion."""
    return cohort.where((F.col(included) == "Y") & (F.col(completion) == 1))


def exclude_location(df: DataFrame, location: str = "M", column: str = "test_location", keep_missing: bool = False) -> DataFrame:
    """Drop one test location.  Rows with no location go too, unless ``keep_missing``."""
    if keep_missing:
        return df.where(differs(F.col(column), F.lit(location)))
    return df.where(F.col(column) != location)


def id_mismatch(df: DataFrame, recorded: str, matched: str) -> DataFrame:
    """Rows whose recorded id is missing or differs from the matched id."""
    return df.where(F.col(recorded).isNull() | (F.col(matched) != F.col(recorded)))


def stack_attempts(parts: Sequence[tuple[DataFrame, Mapping[str, str], str]]) -> DataFrame:
    """Stack score files by column name: (table, new name -> old name, source label) each."""
    tables = [
        df.select(*[F.col(old).alias(new) for new, old in names.items()], F.lit(label).alias("file"))
        for df, names, label in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def decode_attempts(attempts: DataFrame, key: str, date: str = "test_date") -> DataFrame:
    """Packed month-year code to a date, id to a number."""
    return attempts.withColumns({date: month_year_code(F.col(date)), key: to_number(F.col(key).cast("string"), "bigint")})


def benchmark_flags(
    df: DataFrame,
    thresholds: Mapping[str, int] = BENCHMARKS,
    mode: str = "gated",
    gate: str = "composite",
    prefix: str = "n_cr_",
) -> DataFrame:
    """One 0/1 column per subject and one for all of them.

    ``gated``: missing where the gate is missing; ``ungated``: missing where the
    subject is missing; ``zero``: never missing, a missing score is 0.
    """
    met = {s: F.col(s) >= t for s, t in thresholds.items()}
    every = reduce(lambda a, b: a & b, met.values())

    def out(cond: Column) -> Column:
        if mode == "gated":
            return F.when(F.col(gate).isNotNull(), flag(cond))
        if mode == "ungated":
            return flag(cond)
        if mode == "zero":
            return flag(is_true(cond))
        raise ValueError(mode)

    return df.withColumns({**{prefix + s: out(c) for s, c in met.items()}, prefix + "all": out(every)})


def student_level(
    cohort: DataFrame,
    attempts: DataFrame,
    cohort_key: str = "student_key",
    attempt_key: str = "student_id",
    order: Order = SCORE_FIRST,
    thresholds: Mapping[str, int] = BENCHMARKS,
    keys_present: bool = False,
) -> DataFrame:
    """Graduates with their best attempt and gated flags; scores are blank where the composite is.

    ``keys_present``: the cohort has no missing key, see ``attach``.
    """
    best = best_record(attempts, attempt_key, order)
    students = attach(graduates(cohort), best, cohort_key, attempt_key, keys_present)
    blanked = [*thresholds, *[c for c in ["file"] if c in students.columns]]
    flagged = benchmark_flags(students, thresholds, "gated")
    return flagged.withColumns(
        {c: if_else(F.col("composite").isNull(), None, F.col(c)) for c in blanked}
    )


def student_level_fill(
    cohort: DataFrame,
    crosswalk: DataFrame,
    state_day: DataFrame,
    cohort_key: str = "student_key",
    crosswalk_key: str = "student_id",
    state_day_key: str = "student_id",
    thresholds: Mapping[str, int] = BENCHMARKS,
    keys_present: bool = False,
    order: Order = SUBJECT_FIRST,
    names: Sequence[str] = (),
) -> DataFrame:
    """Graduates with the crosswalk's best record; each score still missing is then
    filled from the first state-day value that is not missing.  Flags are never missing.

    ``names`` are further state-day columns, such as the student's names: the first value in
    ``order`` that is not missing, or the cohort's own where it has one.
    """
    scores = SCORES
    kept = graduates(cohort)
    best = best_record(crosswalk.select(crosswalk_key, *scores), crosswalk_key, SUBJECT_FIRST)
    students = attach(kept, best, cohort_key, crosswalk_key, keys_present)
    taken = [*scores, *names]
    day = first_nonmissing(
        exclude_location(state_day, keep_missing=True), state_day_key, order, taken
    ).withColumnsRenamed({c: f"day_{c}" for c in taken})
    joined = attach(students, day, cohort_key, state_day_key, keys_present)
    filled = joined.withColumns({c: F.coalesce(c, f"day_{c}") if c in joined.columns else F.col(f"day_{c}") for c in taken})
    return benchmark_flags(filled.drop(*[f"day_{c}" for c in taken]), thresholds, "zero")
