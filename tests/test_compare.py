"""Comparison without a join, values carried forward, first values in any order."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from acctcube.operators.best import first_nonmissing, first_rows, sort_columns
from acctcube.operators.carry import carry_forward
from acctcube.operators.reconcile import mismatch_counts, paired, reconcile_side_by_side, reconcile_tolerance
from acctcube.suite import queries as q

SCHEMA = "k int, s string, v double, n int"


def unique_tables(frame, seed):
    rng = random.Random(seed)
    keys = [(k, s) for k in [None, *range(12)] for s in [None, "x", "y"]]

    def table():
        return [(k, s, rng.choice([None, 1.0, 1.05, 2.0]), rng.choice([None, 1, 2])) for k, s in keys if rng.random() < 0.8]

    a, b = table(), table()
    return a, b, frame(a, SCHEMA), frame(b, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_unique_keys_as_a_full_join(frame, seed):
    a, b, da, db = unique_tables(frame, seed)
    of_a, of_b = ({r[:2]: r[2:] for r in rows} for rows in (a, b))
    every = sorted({*of_a, *of_b}, key=str)
    none = (None, None)
    side = reconcile_side_by_side(da, db.withColumnsRenamed({"v": "w", "n": "m"}), ["k", "s"], {"v": "w", "n": "m"})
    expect = Counter((*k, of_a.get(k, none)[0], of_b.get(k, none)[0], of_a.get(k, none)[1], of_b.get(k, none)[1]) for k in every)
    assert Counter(map(tuple, side.collect())) == expect
    far = reconcile_tolerance(da, db, ["k", "s"], ["v"])
    assert far.columns == ["k", "s", "v_x", "v_y"]
    assert sorted(map(tuple, far.collect()), key=str) == sorted(
        [(*k, of_a[k][0], of_b[k][0]) for k in every if k in of_a and k in of_b and None not in (of_a[k][0], of_b[k][0])
         and abs(of_a[k][0] - of_b[k][0]) > 0.1], key=str)
    counts = dict(map(tuple, mismatch_counts(da, db, ["k", "s"], ["v", "n"]).collect()))
    assert counts == {c: sum(of_a.get(k, none)[i] != of_b.get(k, none)[i] for k in every) for i, c in enumerate("vn")}


def test_repeated_keys_pair_once(frame):
    # the missing key holds most rows; equal ones cancel, the others are paired one to one
    a = [(None, "x", float(i % 7), 1) for i in range(900)] + [(1, "x", 5.0, 1)] * 5000
    b = [(None, "x", float(i % 5), 1) for i in range(900)] + [(1, "x", 5.0, 1)] * 4999
    pairs = paired(frame(a, SCHEMA), frame(b, SCHEMA), ["k", "s"], {"v": "v", "n": "n"}).collect()
    ours, theirs = Counter(r[2] for r in a if r[0] is None), Counter(r[2] for r in b if r[0] is None)
    assert Counter(r["_x"].v for r in pairs if r.k is None and r["_x"]) == ours
    assert Counter(r["_y"].v for r in pairs if r.k is None and r["_y"]) == theirs
    equal = sum(r.k is None and r["_x"] is not None and r["_x"] == r["_y"] for r in pairs)
    assert equal == (ours & theirs).total() and sum(r.k is None for r in pairs) == 900
    assert Counter((bool(r["_x"]), bool(r["_y"])) for r in pairs if r.k == 1) == {(True, True): 4999, (True, False): 1}
    only = paired(frame(a, SCHEMA), frame(b, SCHEMA), ["k", "s"], {"v": "v", "n": "n"}, equal=False).collect()
    assert len(only) == 900 - equal + 1
    assert paired(frame([], SCHEMA), frame([], SCHEMA), ["k"], {"v": "v"}).count() == 0


def test_comparison_has_no_join_of_the_tables(spark, sf, plan):
    for name in ("reconcile_tolerance", "reconcile_side_by_side", "mismatch_counts", "mismatch_hot_key"):
        text = plan(q.QUERIES[name](spark, sf))
        assert "FullOuter" not in text


def test_hot_key_is_counted_before_the_shuffle(spark, plan):
    # 200,000 rows under one key, two values: a task hands on one row for each value
    rows = spark.range(0, 200000, 1, 8).select(F.lit(None).cast("int").alias("k"), (F.col("id") % 2).alias("v"))
    df = mismatch_counts(rows, rows.withColumn("v", F.lit(0).cast("long")), ["k"], ["v"])
    assert df.collect()[0].n_mismatch == 100000


def rows_shuffled(df):
    """Rows that the last run of ``df`` sent through its exchanges."""

    def written(node):
        kind, n = node.getClass().getSimpleName(), node.metrics().get("shuffleRecordsWritten")
        below = [node.children().apply(i) for i in range(node.children().size())]
        if kind == "AdaptiveSparkPlanExec":
            below = [node.executedPlan()]
        elif kind.endswith("QueryStageExec"):
            below = [node.plan()]
        return (n.get().value() if n.isDefined() else 0) + sum(map(written, below))

    return written(df._jdf.queryExecution().executedPlan())


def test_copies_that_differ_are_counted_not_made(spark):
    # a million rows under the missing key, none equal to one of the other side
    rows = spark.range(0, 1000000, 1, 8).select("id", F.lit(None).cast("int").alias("k"), (F.col("id") % 2).alias("v"))
    df = mismatch_counts(rows, rows.where("id < 900000").withColumn("v", F.col("v") + 5), ["k"], ["v"])
    assert df.collect()[0].n_mismatch == 1000000
    assert 0 < rows_shuffled(df) < 20000


def test_copies_over_many_blocks(frame):
    # copies that begin and end inside blocks, at their bounds and behind the end of the other side
    for a, b in (
        ({"p": 5000, "q": 2048, "r": 1}, {"s": 7049}), ({"p": 4096}, {"s": 2048, "t": 2048}), ({"p": 1}, {"s": 9000, "t": 3}),
        ({"p": 3000, None: 3000}, {}), ({}, {None: 2049}), ({"p": 100, "q": 4000}, {"q": 10, "s": 2100, None: 1995}),
    ):
        ours, theirs = ([(None, s) for s, n in side.items() for _ in range(n)] for side in (a, b))
        tables = [frame(rows, "k int, s string") for rows in (ours, theirs)]
        got = Counter(((r["_x"].s,) if r["_x"] else None, (r["_y"].s,) if r["_y"] else None) for r in paired(*tables, ["k"], {"s": "s"}).collect())
        assert got.total() == max(len(ours), len(theirs))
        assert sum(n for (x, y), n in got.items() if x and y) == min(len(ours), len(theirs))
        for side, rows in enumerate((ours, theirs)):
            found = Counter()
            for pair, n in got.items():
                found[pair[side]] += n
            found.pop(None, None)
            assert found == Counter((s,) for _, s in rows)
        differ = sum(n for (x, y), n in got.items() if (x or (None,)) != (y or (None,)))
        assert mismatch_counts(*tables, ["k"], ["s"]).collect()[0].n_mismatch == differ


# ---- carry forward ---------------------------------------------------------


def test_carry_forward_equal_rows(frame):
    # half of the rows equal, some orders missing, values present come first among equals
    rng = random.Random(3)
    rows = [(5, None)] * 2000 + [(rng.choice([None, *range(40)]), rng.choice([None, None, "a", "b"])) for _ in range(2000)]
    df = frame([(k, v, i) for i, (k, v) in enumerate(rows)], "k int, v string, i int").repartition(6)
    got = {r.i: r.f for r in carry_forward(df, ["k"], ["v"], {"v": "f"}).collect()}
    last, expect = None, {}
    for k, v in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        last = v if v is not None else last
        expect[k, v] = last
    assert len(got) == len(rows) and all(got[i] == expect[r] for i, r in enumerate(rows))
    assert carry_forward(df.limit(0), ["k"], ["v"]).count() == 0


def test_carry_forward_runs_no_job_when_built(spark, frame, plan):
    df = frame([(1, "a"), (2, None)], "k int, v string")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    out = carry_forward(df, ["k"], ["v"])
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert "RDD" not in plan(out).replace("ExistingRDD", "").replace("LogicalRDD", "") and len(out.collect()) == 2


# ---- first values ----------------------------------------------------------

KINDS = "key int, i int, l bigint, d double, m decimal(9,2), b boolean, day date, at timestamp, s string, v string, w int"


def mixed_rows(n):
    rng = random.Random(11)
    some = [
        [None, -(2**31), 2**31 - 1, 0, 1], [None, -(2**63), 2**63 - 1, 3], [None, -1.5, 0.0, 2.5], [None, 1, -2], [None, True, False],
        [None, dt.date(1969, 1, 1), dt.date(2017, 2, 1)], [None, dt.datetime(1960, 1, 1, 3), dt.datetime(2017, 1, 1)],
        [None, "", "a", "ab", "b", "é", "a\0"],
    ]
    return [(rng.randrange(6), *[rng.choice(c) for c in some], rng.choice([None, "p", "q", "r"]), rng.choice([None, 1, 2])) for _ in range(n)]


@pytest.mark.parametrize("order", [["i"], ["-s", "i"], ["s", "-i"], ["b", "l", "-d"], ["day", "-at", "m"], ["at", "-day", "-b", "s"], ["-m", "d", "-l"]])
def test_first_nonmissing_in_any_order(spark, frame, order):
    from decimal import Decimal

    rows = [(*r[:4], None if r[4] is None else Decimal(r[4]), *r[5:]) for r in mixed_rows(400)]
    df = frame(rows, KINDS).repartition(5)
    got = {r.key: (r.v, r.w) for r in first_nonmissing(df, "key", order, ["v", "w"]).collect()}
    for key, found in got.items():
        own = df.where(F.col("key") == key)
        for c, value in zip("vw", found, strict=True):
            first = own.where(F.col(c).isNotNull()).orderBy(*sort_columns(order), F.desc(c)).first()
            assert value == (first[c] if first else None)


def test_first_nonmissing_refuses_what_has_no_order(frame):
    with pytest.raises(TypeError):
        first_nonmissing(frame([(1, [1], 2)], "key int, a array<int>, v int"), "key", ["a"], ["v"])


def test_first_rows(frame, plan):
    df = frame([(i % 4 or None, -i, f"r{i % 3}") for i in range(50)], "k int, i int, s string").repartition(4)
    out = first_rows(df, 5, ["-k", "s"])
    assert [tuple(r) for r in out.collect()] == [(3, -39, "r0"), (3, -27, "r0"), (3, -15, "r0"), (3, -3, "r0"), (3, -43, "r1")]
    assert "TakeOrderedAndProject" in plan(out)
    assert first_rows(df, 0, ["k"]).count() == 0 and first_rows(df, 100, ["k"]).count() == 50
