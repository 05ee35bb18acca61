from itertools import product

from acctcube.operators.appeals import appeal_indicators, approved_appeals, merge_appeals

SUBJECTS = ["english", "math", "reading", "science"]


def by_steps(c, big_c, s, big_s, refill):
    """The override one assignment at a time, as the scripts state it."""

    def ifelse(cond, a, b):
        return None if cond is None else (a if cond else b)

    def above(x, y):
        return None if x is None or y is None else x > y

    subject = ifelse(c is None and big_c is not None, big_s, s)
    subject = ifelse(big_c is None, subject, ifelse(above(big_c, c), big_s, subject))
    comp = ifelse(c is None and big_c is not None, big_c, c)
    comp = ifelse(big_c is None, comp, ifelse(above(big_c, comp), big_c, comp))
    if refill and subject is None and big_s is not None:
        subject = big_s
    return subject, comp


def test_merge_appeals_grid(frame):
    grid = list(product([None, 20], [None, 19, 20, 25], [None, 18], [None, 30]))
    students = frame(
        [(i, s, s, s, s, c) for i, (c, _, s, _) in enumerate(grid)],
        "student_key bigint, english int, math int, reading int, science int, composite int",
    )
    appeals = frame(
        [(i, bs, bs, bs, bs, bc) for i, (_, bc, _, bs) in enumerate(grid)],
        "student_key bigint, " + ", ".join(f"act_{s}_highest int" for s in [*SUBJECTS, "composite"]),
    )
    for refill in (True, False):
        out = {r.student_key: r for r in merge_appeals(students, appeals, refill=refill).collect()}
        for i, (c, bc, s, bs) in enumerate(grid):
            expect = by_steps(c, bc, s, bs, refill)
            for subject in SUBJECTS:
                assert (out[i][subject], out[i].composite) == expect, (grid[i], refill, subject)


def test_students_without_appeal_keep_scores(frame):
    students = frame(
        [(1, 10, 11, 12, 13, 14)],
        "student_key bigint, english int, math int, reading int, science int, composite int",
    )
    appeals = frame([], "student_key bigint, " + ", ".join(f"act_{s}_highest int" for s in [*SUBJECTS, "composite"]))
    assert merge_appeals(students, appeals).first()[:6] == (1, 10, 11, 12, 13, 14)


def test_approved_appeals(frame):
    df = frame(
        [(1, "Approved", "20", "1000"), (None, "Approved", "20", None), (2, "Denied", "20", None), (3, None, "x", "1")],
        "student_id bigint, status string, act_composite_highest string, sat_total string",
    )
    out = approved_appeals(df)
    assert out.columns == ["student_key", "act_composite_highest", "sat_total"]
    assert [tuple(r) for r in out.collect()] == [(1, 20, 1000)]


def test_indicators(frame):
    cases = [
        # composite, total, gender -> tested, 21+, below 19, female 21+, male below
        ((None, 1060, "F"), (1, 1, 0, 1, 0)),
        ((None, 1059, "F"), (1, 0, 0, 0, 0)),
        ((None, 980, "M"), (1, 0, 0, 0, 0)),
        ((None, 979, "M"), (1, 0, 1, 0, 1)),
        ((None, None, "F"), (0, 0, 0, 0, 0)),
        ((21, 400, "F"), (1, 1, 0, 1, 0)),
        ((20, 1600, "F"), (1, 0, 0, 0, 0)),
        ((18, 1600, "M"), (1, 0, 1, 0, 1)),
        ((30, None, None), (1, 1, 0, None, 0)),
        ((10, None, None), (1, 0, 1, 0, None)),
    ]
    df = frame(
        [(i, 18, 22, 22, 23, *c) for i, (c, _) in enumerate(cases)],
        "i int, english int, math int, reading int, science int, composite int, sat_total int, gender string",
    )
    cols = ["tested", "n_21_or_higher", "n_below_19", "n_female_21_or_higher", "n_male_below_19"]
    got = [tuple(r) for r in appeal_indicators(df).orderBy("i").select(cols).collect()]
    assert got == [e for _, e in cases]
    flags = appeal_indicators(df).select("n_cr_all", "enrolled", "valid_tests_female").orderBy("i").collect()
    assert {r.n_cr_all for r in flags} == {1} and {r.enrolled for r in flags} == {1}
    assert [r.valid_tests_female for r in flags] == [1, 1, 0, 0, 0, 1, 1, 0, None, None]
