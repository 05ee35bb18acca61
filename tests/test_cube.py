import random

import pytest
from pyspark.sql import functions as F

from acctcube.operators.cohort import benchmark_flags
from acctcube.operators.cube import (
    Level,
    Subgroup,
    Subgroups,
    all_subgroups,
    fixed_subgroups,
    label_codes,
    subgroup_cube,
)
from acctcube.operators.measures import (
    Measure,
    Summary,
    indicator_summary,
    missing_gender_summary,
    rates,
    rates_missing_gender,
    rates_suppressed,
    score_measures,
    score_summary,
)
from acctcube.operators.appeals import appeal_indicators

SCHEMA = (
    "system int, school int, gender string, race_ethnicity string, econ_dis string, el string, swd string,"
    " english int, math int, reading int, science int, composite int"
)


@pytest.fixture(scope="module")
def students(spark):
    rng = random.Random(11)
    score = lambda: rng.choice([None, *range(10, 36)])
    rows = []
    for _ in range(700):
        # one district holds most of the students
        system = 1 if rng.random() < 0.6 else rng.randrange(2, 6)
        rows.append(
            (
                system, rng.randrange(1, 4), rng.choice(["F", "M", "F", "M", None]),
                rng.choice(["A", "B", "H", "I", "W", "Z", "Q", None]), rng.choice(["Y", "N", None]),
                rng.choice(["N", None]), rng.choice(["Y", "N"]),
                score(), score(), score(), score(), score(),
            )
        )
    return benchmark_flags(spark.createDataFrame(rows, SCHEMA)).cache()


def test_subgroup_rows_equal_filter_then_aggregate(students):
    cube = subgroup_cube(students, score_summary()).cache()
    spec = fixed_subgroups()
    for level, keys in (("school", ["system", "school"]), ("district", ["system"]), ("state", [])):
        for sub in spec:
            if sub.label == "English Learners":
                continue
            direct = score_summary().by(students.where(sub.member), *keys)
            mine = cube.where((F.col("level") == level) & (F.col("subgroup") == sub.label)).select(direct.columns)
            assert sorted(map(str, mine.collect())) == sorted(map(str, direct.collect())), (level, sub.label)
    cube.unpersist()


def test_totals_add_up(students):
    cube = subgroup_cube(students, Summary([Measure("enrolled", F.lit(1))], []))
    n = {(r.level, r.subgroup): r.n for r in cube.groupBy("level", "subgroup").agg(F.sum("enrolled").alias("n")).collect()}
    total = students.count()
    assert n["state", "All Students"] == n["district", "All Students"] == n["school", "All Students"] == total
    missing = students.where("econ_dis is null").count()
    yes, no = n["state", "Economically Disadvantaged"], n["state", "Non-Economically Disadvantaged"]
    assert yes + no + missing == total


def test_empty_subgroup_only_in_the_state_rows(students):
    cube = subgroup_cube(students, score_summary())
    empty = cube.where(F.col("subgroup") == "English Learners").collect()
    assert [(r.level, r.system, r.school, r.enrolled, r.tested, r.avg_math) for r in empty] == [("state", 0, 0, 0, 0, None)]
    none = subgroup_cube(students, score_summary(), empty_totals=False)
    assert none.where(F.col("subgroup") == "English Learners").count() == 0


def test_blank_rows_never_make_a_district(students):
    no_count = Summary([Measure("n_cr_math", F.col("n_cr_math"))], [])
    cube = subgroup_cube(students, no_count)
    assert cube.where("level <> 'state' and system = 0").count() == 0
    assert cube.where("level = 'state' and subgroup = 'English Learners' and n_cr_math = 0").count() == 1


def test_missing_district_is_not_the_state(students):
    rows = students.withColumn("system", F.when(F.col("system") != 3, F.col("system")))
    cube = subgroup_cube(rows, score_summary()).where(F.col("subgroup") == "All Students")
    got = {(r.level, r.system): r.enrolled for r in cube.where("level <> 'school'").collect()}
    assert got["district", 0] == students.where("system = 3").count()
    assert got["state", 0] == students.count()


def test_no_rows_at_all(students):
    cube = subgroup_cube(students.where("system < 0"), score_summary())
    assert sorted((r.level, r.enrolled) for r in cube.collect()) == [("state", 0)] * 9


def test_unknown_codes_stay_apart(students):
    cube = subgroup_cube(students, score_summary()).where((F.col("level") == "state") & F.col("subgroup").isNull())
    expect = [students.where(F.col("race_ethnicity") == c).count() for c in "ZQ"]
    assert sorted(r.enrolled for r in cube.collect()) == sorted(expect)


def test_label_codes(frame):
    df = frame([("A",), ("Z",), (None,)], "c string")
    assert [r[0] for r in df.select(label_codes(F.col("c"), {"A": "Asian"})).collect()] == ["Asian", None, None]


def test_strict_counts(frame):
    df = frame(
        [(1, "F", 20), (1, "M", 20), (2, None, 20), (2, "F", 20), (3, None, None), (3, "F", 20)],
        "system int, gender string, composite int",
    )
    strict = Summary([m for m in score_measures() if m.strict], []).by(df, "system").orderBy("system")
    got = [(r.valid_tests_female, r.valid_tests_male) for r in strict.collect()]
    assert got == [(1, 1), (None, None), (1, 0)]


def test_loose_super_means(students):
    rows = appeal_indicators(students.drop(*[c for c in students.columns if c.startswith("n_cr")]).withColumn("sat_total", F.lit(None).cast("int")))
    loose = subgroup_cube(rows, indicator_summary(keep_ungated=True), all_subgroups(loose_super=True))
    tight = subgroup_cube(rows, indicator_summary())
    bhn = F.coalesce(F.col("race_ethnicity").isin("B", "H", "I"), F.lit(False))
    other = F.expr("coalesce(econ_dis = 'Y', false) or coalesce(el = 'Y', false) or coalesce(swd = 'Y', false)")
    use = other | (bhn & F.col("composite").isNotNull())
    for level, keys in (("district", ["system"]), ("state", [])):
        expect = rows.where(use).groupBy(*keys).agg(F.avg("math").alias("m"), F.count("math").alias("n"))
        got = loose.where((F.col("level") == level) & (F.col("subgroup") == "Super Subgroup"))
        pairs = got.join(expect, keys) if keys else got.crossJoin(expect)
        assert all(abs(r.avg_math - r.m) <= 0.0501 for r in pairs.collect())
    same = [c for c in tight.columns]
    rest = F.coalesce(F.col("subgroup") != "Super Subgroup", F.lit(True))
    assert sorted(map(str, loose.where(rest).select(same).collect())) == sorted(map(str, tight.where(rest).collect()))
    a = loose.where((F.col("level") == "state") & ~rest).first()
    b = tight.where((F.col("level") == "state") & ~rest).first()
    assert a.enrolled == b.enrolled and a.avg_composite == b.avg_composite


def test_own_subgroups_and_levels(students):
    spec = Subgroups([Subgroup("Math 20+", F.col("strong"))], ["strong"])
    rows = students.withColumn("strong", F.col("math") >= 20)
    cube = subgroup_cube(rows, score_summary(), spec, [Level("school type", ["school"])])
    direct = score_summary().by(rows.where("strong"), "school")
    assert {(r.school, r.enrolled) for r in cube.collect()} == {(r.school, r.enrolled) for r in direct.collect()}


def test_bands_leave_a_gap(frame):
    df = frame([(21,), (20,), (19,), (18,), (None,)], "composite int").withColumn("gender", F.lit("F"))
    for flag in ("english", "math", "reading", "science", "all"):
        df = df.withColumn(f"n_cr_{flag}", F.lit(0))
    row = Summary(score_measures(), []).by(df).first()
    assert (row.enrolled, row.tested, row.n_21_or_higher, row.n_below_19) == (5, 4, 1, 1)
    half_up = missing_gender_summary()
    counts = Summary(half_up.measures, []).by(df).first()
    assert (counts.n_21_or_higher, counts.n_below_19, counts.n_gender_missing) == (1, 1, 0)


def test_missing_gender_rates(students):
    df = rates_missing_gender(missing_gender_summary().by(students.na.fill({"gender": ""}), "system"))
    assert "n_gender_missing" not in df.columns and "pct_gender_missing_below_19" in df.columns
    plain = rates_missing_gender(missing_gender_summary().by(students, "system"))
    # blank and missing gender are the same
    assert sorted(map(str, df.collect())) == sorted(map(str, plain.collect()))


def test_rates_and_suppression(frame):
    names = [f"n_cr_{s}" for s in ("english", "math", "reading", "science", "all")] + ["n_21_or_higher", "n_below_19"]
    names += [f"n_{g}_{b}" for b in ("21_or_higher", "below_19") for g in ("female", "male")]
    schema = "enrolled long, tested long, valid_tests long, valid_tests_male long, valid_tests_female long, " + ", ".join(f"{n} long" for n in names)
    df = frame([(30, 29, 29, None, 10, *[5] * 11), (40, 30, 30, 20, 0, *[5] * 11), (0, 0, 0, 0, 0, *[0] * 11)], schema)
    a, b, c = rates(df).collect()
    assert (a.pct_male_below_19, a.pct_female_below_19, a.participation_rate) == (None, 50.0, 97.0)
    assert (b.pct_female_below_19, b.pct_cr_all) == (None, 16.7)
    assert c.pct_cr_all is None and c.participation_rate is None
    a, b, c = rates_suppressed(df).collect()
    assert (a.pct_cr_all, a.participation_rate) == (None, 97.0)
    assert (b.pct_female_below_19, b.participation_rate) == (16.7, 75.0)
    assert c.participation_rate is None


def test_plan_is_one_pass_and_jvm_only(students, plan):
    df = rates(subgroup_cube(students, score_summary()))
    text = plan(df)
    physical = text[text.index("== Physical Plan") :]
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Join"):
        assert bad not in physical
    assert physical.count("+- Exchange hashpartitioning") == 2
