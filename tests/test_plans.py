"""Physical plans at the sizes that matter: no broadcasts, large scans."""

import re
from contextlib import contextmanager

import pytest

from acctcube.operators.appeals import merge_appeals
from acctcube.operators.cohort import student_level
from acctcube.operators.joins import attach_unique
from acctcube.session import scratch_path
from acctcube.sources import save_bucketed, save_table
from acctcube.suite import queries as q, tables as t

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
LARGE_SCAN = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


@contextmanager
def settings(spark, **pairs):
    pairs = {k.replace("__", "."): v for k, v in pairs.items()}
    old = {k: spark.conf.get(k) for k in pairs}
    for k, v in pairs.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def landed(spark, sf):
    """Tables as a user has them: landed, not derived."""
    return {
        "cohort": save_table(t.cohort(spark, sf), scratch_path(spark, "cohort")),
        "attempts": save_table(q.decoded(spark, sf), scratch_path(spark, "attempts")),
        "appeals": save_table(q.approved(spark, sf), scratch_path(spark, "appeals")),
    }


def physical(plan, df):
    text = plan(df)
    return text[text.index("== Physical Plan") :]


def test_each_table_is_shuffled_once(spark, landed, plan):
    with settings(spark, **{THRESHOLD: "-1"}):
        df = merge_appeals(
            student_level(landed["cohort"], landed["attempts"], keys_present=True), landed["appeals"], keys_present=True
        )
        text = physical(plan, df)
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("SortMergeJoin") == 2 and "Broadcast" not in text


def test_missing_keys_read_each_table_once(spark, landed, plan):
    cohort = t.with_gaps(landed["cohort"], "student_key", 3, 0)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = merge_appeals(student_level(cohort, landed["attempts"]), landed["appeals"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before  # no job at build
    with settings(spark, **{THRESHOLD: "-1"}):
        text = physical(plan, merge_appeals(student_level(cohort, landed["attempts"]), landed["appeals"]))
    assert text.count("FileScan") == 3 and text.count("SortMergeJoin") == 2
    assert df.where("student_key is null").count() > 1


def test_hot_key_is_split_between_tasks(spark, plan):
    skew = {f"spark.sql.adaptive.{k}": v for k, v in {
        "skewJoin.skewedPartitionThresholdInBytes": "20000",
        "skewJoin.skewedPartitionFactor": "2",
        "advisoryPartitionSizeInBytes": "20000",
        "autoBroadcastJoinThreshold": "-1",
    }.items()}
    left = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 1, 7, id) as key", "id as v")
    right = spark.range(0, 60000, 1, 8).selectExpr("id", "id * 2 as w")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    with settings(spark, **skew, **{THRESHOLD: "-1"}):
        df = attach_unique(left, right, "key", "id")
        assert len(df.collect()) == 60000
        text = physical(plan, df)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin(skew=true)" in text


def test_only_needed_columns_are_read(spark, landed, plan):
    df = student_level(landed["cohort"], landed["attempts"]).select("system", "composite")
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", physical(plan, df))
    cohort = next(r for r in reads if "student_key" in r)
    assert "gender" not in cohort and "race_ethnicity" not in cohort
    pushed = re.findall(r"PushedFilters: \[([^]]*)\]", physical(plan, df))
    assert any("EqualTo(included_in_cohort,Y)" in p and "EqualTo(completion_type,1)" in p for p in pushed)


def test_cohort_filters_a_large_scan_of_attempts(spark, landed, plan):
    with settings(spark, **{THRESHOLD: "-1", LARGE_SCAN: "0"}):
        df = student_level(landed["cohort"], landed["attempts"])
        text = physical(plan, df)
        assert df.count() == student_level(landed["cohort"], landed["attempts"]).count()
    # below the rank and its shuffle
    assert text.index("might_contain") > text.rindex("WindowGroupLimit")


def test_bucketed_tables_need_no_shuffle(spark, landed, plan):
    expect = student_level(landed["cohort"], landed["attempts"])
    cohort = save_bucketed(landed["cohort"], "cohort_b", scratch_path(spark, "cohort_b"), "student_key", 8)
    attempts = save_bucketed(landed["attempts"], "attempts_b", scratch_path(spark, "attempts_b"), "student_id", 8)
    with settings(spark, **{THRESHOLD: "-1"}):
        df = student_level(cohort, attempts, keys_present=True)
        assert "Exchange" not in physical(plan, df)
        assert sorted(map(str, df.collect())) == sorted(map(str, expect.collect()))
    spark.sql("drop table cohort_b")
    spark.sql("drop table attempts_b")
