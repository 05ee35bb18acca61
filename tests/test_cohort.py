import random

import pytest
from pyspark.sql import functions as F

from acctcube.operators.best import SUBJECT_FIRST, best_record, first_nonmissing
from acctcube.operators.cohort import (
    benchmark_flags,
    exclude_location,
    id_mismatch,
    student_level,
    student_level_fill,
)
from acctcube.operators.joins import attach_unique, full_join, merge_status

ATT = (
    "student_id bigint, english int, math int, reading int, science int, composite int, test_date date, file string"
)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((v is None, v) for v in r))


def test_best_record_order(frame):
    att = frame(
        [
            (1, 10, 10, 10, 10, 20, None, "b"),
            (1, 30, 10, 10, 10, 20, None, "b"),
            (1, 30, 10, 10, 10, 20, None, "a"),
            (1, 36, 36, 36, 36, None, None, "a"),
            (2, 5, None, 5, 5, 9, None, "c"),
            (2, 5, 1, 5, 5, 9, None, "c"),
            (None, 1, 1, 1, 1, 1, None, "x"),
            (None, 1, 1, 1, 1, 2, None, "x"),
        ],
        ATT,
    )
    got = rows(best_record(att, "student_id"), "student_id", "english", "math", "composite", "file")
    assert got == [(1, 30, 10, 20, "a"), (2, 5, 1, 9, "c"), (None, 1, 1, 2, "x")]


def test_first_nonmissing_mixes_rows(frame):
    schema = "id int, english int, math int, reading int, science int, composite int"
    att = frame([(1, None, 5, 5, 5, 30), (1, 20, 9, None, 5, 25), (1, 36, 36, 36, 36, None), (2, None, None, None, None, None)], schema)
    scores = ["english", "math", "reading", "science", "composite"]
    got = rows(first_nonmissing(att, "id", SUBJECT_FIRST, scores), "id", *scores)
    assert got == [(1, 20, 5, 5, 5, 30), (2, None, None, None, None, None)]
    first = rows(best_record(att, "id", SUBJECT_FIRST), "id", *scores)
    assert first[0] == (1, None, 5, 5, 5, 30)


def test_first_nonmissing_random(frame):
    rng = random.Random(3)
    pickv = lambda: rng.choice([None, *range(1, 6)])
    data = [(rng.randrange(40), pickv(), pickv(), pickv(), pickv(), pickv()) for _ in range(600)]
    scores = ["composite", "english", "math", "reading", "science"]
    df = frame(data, "id int, " + ", ".join(f"{s} int" for s in scores))
    expect = []
    for key in sorted({r[0] for r in data}):
        group = sorted((r[1:] for r in data if r[0] == key), key=lambda r: [(v is None, -(v or 0)) for v in r])
        expect.append((key, *[next((r[i] for r in group if r[i] is not None), None) for i in range(5)]))
    assert rows(first_nonmissing(df, "id", SUBJECT_FIRST, scores), "id", *scores) == expect


def test_flags_thresholds_and_modes(frame):
    df = frame(
        [(18, 22, 22, 23, 21), (17, 22, 22, 23, 21), (30, None, 22, 23, 21), (30, 30, 30, 30, None)],
        "english int, math int, reading int, science int, composite int",
    )
    flags = ["n_cr_english", "n_cr_math", "n_cr_reading", "n_cr_science", "n_cr_all"]
    by = {m: [tuple(r) for r in benchmark_flags(df, mode=m).select(flags).collect()] for m in ("gated", "ungated", "zero")}
    assert by["gated"] == [(1, 1, 1, 1, 1), (0, 1, 1, 1, 0), (1, None, 1, 1, None), (None,) * 5]
    assert by["ungated"] == [(1, 1, 1, 1, 1), (0, 1, 1, 1, 0), (1, None, 1, 1, None), (1, 1, 1, 1, 1)]
    assert by["zero"] == [(1, 1, 1, 1, 1), (0, 1, 1, 1, 0), (1, 0, 1, 1, 0), (1, 1, 1, 1, 1)]


def test_location_rules(frame):
    df = frame([("M",), ("S",), (None,), ("",)], "test_location string")
    assert [r[0] for r in exclude_location(df).collect()] == ["S", ""]
    assert [r[0] for r in exclude_location(df, keep_missing=True).collect()] == ["S", None, ""]


def test_id_mismatch(frame):
    df = frame([(1, 1), (1, 2), (None, 3), (4, None)], "recorded int, matched int")
    assert rows(id_mismatch(df, "recorded", "matched"), "recorded", "matched") == [(1, 2), (None, 3)]


COHORT = "student_key bigint, included_in_cohort string, completion_type int"


def test_student_level_blanks_scores(frame):
    cohort = frame([(1, "Y", 1), (2, "Y", 1), (3, "N", 1), (4, "Y", 2), (None, "Y", 1)], COHORT)
    att = frame(
        [(1, 30, 10, 10, 10, 20, None, "a"), (2, 30, 30, 30, 30, None, None, "a"), (None, 7, 7, 7, 7, 7, None, "z")], ATT
    )
    got = rows(student_level(cohort, att), "student_key", "english", "composite", "file", "n_cr_english")
    # a missing id matches a missing key
    assert got == [(1, 30, 20, "a", 1), (2, None, None, None, None), (None, 7, 7, "z", 0)]


def test_student_level_fill(frame):
    cohort = frame([(1, "Y", 1), (2, "Y", 1), (3, "Y", 1)], COHORT)
    scores = "english int, math int, reading int, science int, composite int"
    cross = frame([(1, 20, None, 20, 20, 20), (1, 36, 36, 36, 36, 19)], f"student_id bigint, {scores}")
    day = frame(
        [(1, 1, 30, 1, 1, 30, "S"), (2, None, 25, 9, 9, 22, None), (2, 18, 1, 1, 1, 3, "S"), (2, 36, 36, 36, 36, 36, "M")],
        f"student_id bigint, {scores}, test_location string",
    )
    got = rows(student_level_fill(cohort, cross, day), "student_key", "english", "math", "composite", "n_cr_english", "n_cr_math")
    assert got == [(1, 20, 30, 20, 1, 1), (2, 18, 25, 22, 1, 1), (3, None, None, None, 0, 0)]


@pytest.mark.parametrize("with_missing", [False, True])
def test_attach_unique(frame, with_missing):
    left_rows = [(7, i) for i in range(30)] + [(k, k) for k in (1, 2, 3)]
    left_rows += [(None, -i) for i in range(1, 300)] if with_missing else []
    left = frame(left_rows, "key bigint, v int")
    right = frame([(7, "seven"), (2, "two"), (9, "nine"), (None, "none")], "id bigint, name string")
    names = {7: "seven", 2: "two", None: "none"}
    expect = sorted(((k, v, names.get(k)) for k, v in left_rows), key=str)
    assert sorted(map(tuple, attach_unique(left, right, "key", "id").collect()), key=str) == expect
    if not with_missing:  # the right side's missing key is no error
        out = attach_unique(left, right, "key", "id", keys_present=True)
        assert sorted(map(tuple, out.collect()), key=str) == expect


@pytest.mark.parametrize("key", [2, None])
def test_attach_unique_wants_one_row_per_key(frame, key):
    right = frame([(key, "a"), (key, "b"), (3, "c")], "id bigint, name string")
    with pytest.raises(Exception, match="id repeats"):
        attach_unique(frame([(1,)], "key bigint"), right, "key", "id").collect()


def test_keys_present_raises_on_a_missing_key(frame):
    left, right = frame([(1,), (None,)], "key bigint"), frame([(1, "a")], "id bigint, name string")
    with pytest.raises(Exception, match="missing key"):
        attach_unique(left, right, "key", "id", keys_present=True).collect()


def test_attach_empty_tables(frame):
    left, right = frame([(None,), (1,)], "key bigint"), frame([], "id bigint, name string")
    assert sorted(map(tuple, attach_unique(left, right, "key", "id").collect()), key=str) == [(1, None), (None, None)]
    assert attach_unique(left.where("key > 5"), right, "key", "id").collect() == []


def test_full_join_matches_missing_keys(frame):
    a = frame([(1, None, 10), (2, "x", 20)], "system int, subgroup string, v int")
    b = frame([(1, None, 11), (3, "x", 30)], "system int, subgroup string, v int")
    got = rows(full_join(a, b, ["system", "subgroup"]), "system", "subgroup", "v_x", "v_y")
    assert got == [(1, None, 10, 11), (2, "x", 20, None), (3, "x", None, 30)]


def test_merge_status(frame):
    a, b = frame([(1,), (2,)], "a int"), frame([(2,), (3,)], "b int")
    assert rows(merge_status(a, b, "a", "b", "id"), "id", "merge_status") == [(1, 1), (2, 3), (3, 2)]


@pytest.mark.parametrize("ours, theirs, codes", [(3, 1, [3, 3, 3]), (3, 0, [1, 1, 1]), (0, 3, [2, 2, 2]), (1, 2, [3, 3])])
def test_merge_status_of_missing_keys(frame, ours, theirs, codes):
    a = frame([(None,)] * ours + [(1,)], "k int")
    b = frame([(None,)] * theirs + [(2,)], "k int")
    got = merge_status(a, b, "k", "k", "id").where("id is null").collect()
    assert [r.merge_status for r in got] == codes


def test_best_record_is_bounded_before_the_shuffle(frame, plan):
    att = frame([(1, 1, 1, 1, 1, 1, None, "a")], ATT)
    text = plan(best_record(att, "student_id"))
    physical = text[text.index("== Physical Plan") :]
    limits = physical.count("WindowGroupLimit")
    assert limits == 2 and physical.index("Exchange") < physical.rindex("WindowGroupLimit")


def test_flags_use_given_thresholds(frame):
    df = frame([(5, 9)], "a int, b int")
    out = benchmark_flags(df, {"a": 5, "b": 10}, mode="ungated", prefix="met_")
    assert out.select("met_a", "met_b", "met_all").first() == (1, 0, 0)
    with pytest.raises(ValueError):
        benchmark_flags(df, {"a": 5}, mode="other")


def test_stacked_dates_are_decoded(frame):
    from acctcube.operators.cohort import decode_attempts, stack_attempts

    a = frame([("1", 416, 20)], "id string, code int, total int")
    b = frame([("x", 1016)], "sid string, d int")
    out = decode_attempts(
        stack_attempts(
            [
                (a, {"student_id": "id", "test_date": "code", "composite": "total"}, "one"),
                (b, {"student_id": "sid", "test_date": "d"}, "two"),
            ]
        ),
        "student_id",
    )
    got = [(r.student_id, str(r.test_date), r.composite, r.file) for r in out.orderBy(F.col("file")).collect()]
    assert got == [(1, "2016-04-01", 20, "one"), (None, "2016-10-01", None, "two")]
