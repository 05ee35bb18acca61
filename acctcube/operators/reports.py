"""Side reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from acctcube.fixed_values import BENCHMARKS, EXTERNAL_COLUMNS, SCORES
from acctcube.functions import pct, round_even, to_number, ymd_text
from acctcube.operators.best import best_record
from acctcube.operators.cohort import benchmark_flags
from acctcube.operators.measures import (
    averages,
    missing_gender_summary,
    rates,
    rates_missing_gender,
    score_measures,
    Summary,
)


def split_code(code: Column, position: int, sep: str = " ") -> Column:
    """One part of a code such as ``"system school"`` as a number; missing when absent."""
    return to_number(F.get(F.split(code, sep), F.lit(position)), "bigint")


def missing_id_report(
    sites: DataFrame,
    tests: DataFrame,
    site_code: str = "org_code",
    local_code: str = "local_site_code",
    test_code: str = "acthscode",
    student: str = "state_stud_id",
) -> DataFrame:
    """Tests and missing student ids per district.

    Every test counts, also one of an unknown site (district missing).  Tests are
    summed per site before the join, so a large site is one row when it is matched.
    """
    code = sites.select(
        to_number(F.col(site_code), "bigint").alias("_code"),
        split_code(F.col(local_code), 0).alias("system"),
    ).where(F.col("_code").isNotNull())
    per_site = tests.groupBy(to_number(F.col(test_code).cast("string"), "bigint").alias("_test_code")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(student).isNull()).alias("n_missing_id")
    )
    return (
        code.join(per_site, F.col("_code") == F.col("_test_code"), "right")
        .groupBy("system")
        .agg(F.sum("n").alias("n"), F.sum("n_missing_id").alias("n_missing_id"))
        .withColumn("pct", round_even(pct(F.col("n_missing_id"), F.col("n")), 1))
        .orderBy(F.desc_nulls_last("pct"), "system")
    )


def unmatched_ids(records: DataFrame, birth: str = "dob", first_id: str = "id", second_id: str = "id2") -> DataFrame:
    """Decoded records without a usable student id.

    The second id always follows the first, so both are missing in the result.
    """
    return records.withColumns(
        {
            birth: ymd_text(F.col(birth)),
            first_id: to_number(F.col(first_id), "bigint"),
            second_id: to_number(F.col(first_id), "bigint"),
        }
    ).where(F.col(first_id).isNull())


def region_rollup(students: DataFrame, regions: DataFrame, state_label: str = "State") -> DataFrame:
    """Counts per region with the state row first.

    Students are summed per district before the region is attached; districts
    without a region appear in the state row only.  The state row does not depend on the
    regions; a district listed twice counts in each of its regions.
    """
    summary = missing_gender_summary()
    per_system = students.groupBy("system").agg(*summary.sums(summary.row_columns()))
    named = per_system.join(regions.select("system", "region"), "system").where(F.col("region") != "")
    state = per_system.agg(*summary.sums()).withColumn("region", F.lit(None).cast(regions.schema["region"].dataType))
    sums = named.groupBy("region").agg(*summary.sums()).unionByName(state)
    rows = rates_missing_gender(summary.finish(sums))
    return (
        rows.orderBy(F.asc_nulls_first("region"))
        .withColumn("region", F.coalesce("region", F.lit(state_label)))
        .withColumn("subgroup", F.lit("All Students"))
    )


WHAT_IF_ORDER = ["-composite", "-math", "-reading", "-english", "-science"]


def what_if_correction(
    official: DataFrame,
    own: DataFrame,
    reported: DataFrame,
    system: int,
    own_key: str = "student_id",
    key: str = "student_key",
    thresholds: Mapping[str, int] = BENCHMARKS,
    subject: str = "ACT",
    grade: str = "9th through 12th",
) -> DataFrame:
    """One district recomputed with its own score file, above the row that was reported.

    The district's scores replace ours where it has one.  Flags and counts use the
    replaced scores; the means stay those of the official scores.
    """
    students = official.where(F.col("system") == system)
    theirs = best_record(own.select(own_key, *SCORES), own_key, WHAT_IF_ORDER)
    theirs = theirs.withColumnsRenamed({own_key: "_own_key", **{c: f"_own_{c}" for c in SCORES}})
    joined = students.join(theirs, F.col(key) == F.col("_own_key"), "left")
    official_means = {f"_official_{c}": F.col(c) for c in SCORES}
    replaced = joined.withColumns({**official_means, **{c: F.coalesce(f"_own_{c}", c) for c in SCORES}})
    flagged = benchmark_flags(replaced, thresholds, "ungated")

    tested = F.col("_official_composite").isNotNull()
    means = [
        type(a)(a.name, F.when(tested, F.col(f"_official_{c}")))
        for a, c in zip(averages(SCORES), SCORES, strict=True)
    ]
    row = rates(Summary(score_measures(), means).by(flagged))
    row = row.withColumnsRenamed({o: t for o, t in EXTERNAL_COLUMNS.items() if o in row.columns}).withColumns(
        {
            "system": F.lit(system),
            "subject": F.lit(subject),
            "grade": F.lit(grade),
            "subgroup": F.lit("All Students"),
        }
    )
    shown = reported.where((F.col("system") == system) & (F.col("subgroup") == "All Students"))
    return row.unionByName(shown, allowMissingColumns=True)
