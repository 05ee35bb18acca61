"""Names, carry forward, comparison, release, side reports, files."""

import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from acctcube.operators.carry import carry_forward
from acctcube.operators.labels import label_names, label_names_forced, names_if_missing, relabel_subgroups
from acctcube.operators.reconcile import mismatch_counts, reconcile_exact, reconcile_side_by_side, reconcile_tolerance
from acctcube.operators.release import Suppression, release_district, release_school, suppress_count, suppress_value
from acctcube.operators.reports import missing_id_report, region_rollup, split_code, unmatched_ids
from acctcube.plans.publish import publish
from acctcube.session import cut_lineage, scratch_path, shared_dir
from acctcube.sources import decode_fixed_width, read_csv, read_fixed_width, save_table, write_csv, write_split, writers
from acctcube.suite import queries as q, tables as t


def test_carry_forward_small(frame):
    df = frame([(i, v) for i, v in enumerate([None, "a", None, "b", None])], "i int, v string")
    out = carry_forward(df, ["i"], ["v"]).orderBy("i").collect()
    assert [r.v for r in out] == [None, "a", "a", "b", "b"]


def test_carry_forward_random_across_ranges(spark, frame):
    rng = random.Random(5)
    rows = [
        (rng.randrange(30), rng.choice([None, *"pqrs"]), i, rng.choice([None] * 30 + ["a", "b"]), rng.choice([None, 1, 2]))
        for i in range(3000)
    ]
    df = frame(rows, "k int, s string, i int, v string, w int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = carry_forward(df, ["k", "s", "i"], ["v", "w"], {"w": "w2"}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {r.i: (r.v, r.w, r.w2) for r in out}
    v = w = None
    for k, s, i, rv, rw in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or "", r[2])):
        v, w = rv if rv is not None else v, rw if rw is not None else w
        assert got[i] == (v, rw, w)
    assert len(out) == len(rows)


def test_carry_forward_splits_ties(spark, frame):
    # one order key holds nearly all rows; they keep their input order
    df = frame([(1, i, "v" if i == 0 else None) for i in range(4000)] + [(2, 4000, None)], "k int, i int, v string").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = carry_forward(df, ["k"], ["v"])
        assert out.where("v is null").count() == 0 and out.count() == 4001
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_label_names(frame):
    base = frame(
        [(0, 0, "All"), (1, 0, "All"), (1, 5, "All"), (2, 0, "All"), (2, 3, "All"), (2, 4, "All")],
        "system int, school int, subgroup string",
    )
    names = frame([(1, 5, "One", "Five"), (2, 3, "Two", None)], "system int, school int, system_name string, school_name string")
    out = label_names(base, names, {(2, 3): "Three", (1, 5): "not used"}).orderBy("system", "school")
    assert [tuple(r) for r in out.collect()] == [
        (0, "State of Tennessee", 0, "All Schools", "All"),
        (1, None, 0, "All Schools", "All"),
        (1, "One", 5, "Five", "All"),
        (2, "One", 0, "All Schools", "All"),
        (2, "Two", 3, "Three", "All"),
        (2, "Two", 4, None, "All"),
    ]


def test_forced_names(frame):
    df = frame([(9, 1), (9, None), (None, 1), (8, None), (None, 2), (9, 2)], "system int, school int")
    names = frame([(9, 1, "Nine", "old")], "system int, school int, system_name string, school_name string")
    named = label_names_forced(df, names, {(9, 1): "new"})
    assert {(r.system, r.school): r.school_name for r in named.collect()}[9, 1] == "new"
    # a comparison with a missing key blanks the name, a false one keeps it
    kept = df.withColumn("school_name", F.lit("kept"))
    out = {
        (r.system, r.school): r.school_name
        for r in label_names_forced(kept, names.drop("school_name"), {(9, 1): "new"}).collect()
    }
    assert out == {(9, 1): "new", (9, None): None, (None, 1): None, (8, None): "kept", (None, 2): "kept", (9, 2): "kept"}


def test_names_if_missing(frame):
    df = frame([(1, 1, None), (1, 1, "x"), (2, 2, None)], "system int, school int, n string")
    got = [r[0] for r in df.select(names_if_missing(F.col("n"), {(1, 1): "a", (3, 3): "b"})).collect()]
    assert got == ["a", "x", None]


def test_relabel(frame):
    df = frame([("English Learners",), ("White",), (None,)], "subgroup string")
    assert [r[0] for r in relabel_subgroups(df).collect()] == ["English Language Learners with T1/T2", "White", None]


@pytest.fixture
def two(frame):
    a = frame([(1, None, 10.0, 5), (2, "x", 20.0, 5), (3, "x", None, 5), (4, "x", 1.0, 1)], "k int, s string, v double, n int")
    b = frame([(1, None, 10.2, 5), (2, "x", 20.05, 6), (3, "x", 3.0, 5), (5, "x", 9.0, 9)], "k int, s string, v double, n int")
    return a, b


def test_reconcile(two):
    a, b = two
    assert [r.k for r in reconcile_tolerance(a, b, ["k", "s"], ["v"]).collect()] == [1]
    exact = reconcile_exact(a, b.withColumnRenamed("n", "m"), ["k", "s"], {"n": "m"})
    assert sorted(r.k for r in exact.collect()) == [2, 4]
    side = reconcile_side_by_side(a, b.withColumnRenamed("v", "w"), ["k", "s"], {"v": "w"})
    assert side.columns == ["k", "s", "v", "w"] and side.count() == 5
    counts = {r.column_name: r.n_mismatch for r in mismatch_counts(a, b, ["k", "s"], ["v", "n"]).collect()}
    assert counts == {"v": 5, "n": 3}


def test_suppression_edges(frame):
    df = frame(
        [(1.0, 10), (99.0, 10), (0.9, 10), (99.1, 10), (50.0, 9), (50.5, 10), (50.0, None), (None, 10), (None, 9)],
        "v double, n int",
    )
    got = [r[0] for r in df.select(suppress_value(F.col("v"), F.col("n"), 1, 99, 10)).collect()]
    assert got == ["1", "99", "**", "**", "*", "50.5", None, None, "*"]
    counts = frame([(0, 10), (1, 10), (10, 10), (5, 9), (0, 0), (3, None)], "c long, n long")
    got = [r[0] for r in counts.select(suppress_count(F.col("c"), F.col("n"), 0.01, 0.99, 10)).collect()]
    assert got == ["**", "1", "**", "*", "*", None]


def test_release_subgroups_and_district(spark, sf):
    pub = q.published(spark, sf, "district")
    names = t.system_names(spark, sf)
    assert release_district(pub, names).select("Subgroup").distinct().count() == 5
    one = release_district(pub, names, Suppression(), district=3)
    assert {r.District for r in one.collect()} == {3}
    school = release_school(q.published(spark, sf, "school"), t.school_names(spark, sf))
    assert not [c for c in school.columns if c.startswith("Number")]


def test_site_codes(frame):
    df = frame([("5",), ("5 7",), (None,), ("a b",)], "c string")
    got = [tuple(r) for r in df.select(split_code(F.col("c"), 0), split_code(F.col("c"), 1)).collect()]
    assert got == [(5, None), (5, 7), (None, None), (None, None)]


def test_missing_id_report(frame):
    sites = frame([("1", "10 1"), ("2", "10 2"), (None, "11 1"), ("3", "12")], "org_code string, local_site_code string")
    tests = frame([(1, None), (1, 5), (2, 6), (3, None), (9, None), (9, 7), (None, 8)], "acthscode int, state_stud_id bigint")
    got = [tuple(r) for r in missing_id_report(sites, tests).collect()]
    assert got[0] == (12, 1, 1, 100.0)
    assert sorted(got[1:], key=str) == sorted([(10, 3, 1, 33.3), (None, 3, 1, 33.3)], key=str)


def test_region_state_row_first(spark, sf):
    rows = region_rollup(q.students_2016(spark, sf), t.regions(spark, sf)).collect()
    assert [r.region for r in rows] == ["State", "AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST"]
    assert rows[0].enrolled > sum(r.enrolled for r in rows[1:])


def test_sorted_release(spark, sf):
    got = [(r.avg_composite is None, -(r.avg_composite or 0), r.system, r.school) for r in q.QUERIES["sort_release"](spark, sf).collect()]
    assert got == sorted(got)


def test_fixed_width_is_cut_by_bytes(frame):
    layout = [("name", 1, 6, "text"), ("score", 7, 8, "number"), ("id", 9, 11, "bigint")]
    df = frame([("Zoë  23  7",), ("Bob   xx12x",), ("short",)], "value string")
    got = [tuple(r) for r in decode_fixed_width(df, layout).collect()]
    # ë takes two bytes
    assert got == [("Zoë", 23.0, 7), ("Bob", None, None), ("short", None, None)]


def test_unmatched_ids(frame):
    df = frame([("20000101", "12", "99"), ("20001301", "", "98"), ("x", "1x", None)], "dob string, id string, id2 string")
    got = [(str(r.dob), r.id, r.id2) for r in unmatched_ids(df).collect()]
    assert got == [("None", None, None), ("None", None, None)]


def test_csv_round_trip(spark, frame):
    df = frame([(1, 'a "quoted", text', 2.5), (None, None, None), (3, "é", 0.1)], "a int, b string, c double")
    for bom in (False, True):
        path = scratch_path(spark, "csv")
        write_csv(df.coalesce(1), path, bom=bom)
        back = read_csv(spark, path, df.schema)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
        # Spark's reader drops the mark, so look at the bytes
        text = next(Path(path).glob("part-*.csv")).read_text("utf-8")
        assert text.startswith("\ufeffa,b,c\n" if bom else "a,b,c\n")
        assert "\n,,\n" in text


def test_bad_csv_cells_become_missing(spark, frame):
    path = scratch_path(spark, "bad")
    frame([("a,b",), ("x,1",), ("2,y",)], "value string").coalesce(1).write.text(path)
    assert [tuple(r) for r in read_csv(spark, path, "a int, b int").collect()] == [(None, 1), (2, None)]


def test_csv_columns_are_found_by_name(spark, frame):
    path = scratch_path(spark, "named")
    frame([("school,System,extra,student_key",), ("7,1,zz,100",)], "value string").coalesce(1).write.text(path)
    rows = read_csv(spark, path, "student_key bigint, system int, school int").collect()
    assert [tuple(r) for r in rows] == [(100, 1, 7)]
    with pytest.raises(ValueError, match="gender"):
        read_csv(spark, path, "gender string")


def test_split_keeps_key_and_all_rows(spark, frame, plan):
    # one key holds two thirds of the rows
    df = frame([(1, i) for i in range(2000)] + [(i % 50 + 2, i) for i in range(1000)], "system int, v int")
    path = scratch_path(spark, "split")
    write_split(df, path, "system", max_records_per_file=500)
    back = spark.read.option("header", True).schema("system int, v int").csv(path)
    assert back.where("system = system_is").count() == 3000
    assert back.select("system_is").distinct().count() == 51
    hot = spark.read.option("header", True).schema("system int, v int").csv(f"{path}/system_is=1")
    assert hot.count() == 2000 and len(hot.inputFiles()) >= 4


def test_fixed_width_file(spark, sf):
    path = scratch_path(spark, "fw")
    t.highest_records(spark, sf).write.text(path)
    from acctcube.fixed_values import HIGHEST_LAYOUT

    df = read_fixed_width(spark, path, HIGHEST_LAYOUT)
    assert df.where("last not like 'Läst%' or english is null").count() == 0
    assert df.where("science is not null").count() == 0


def test_records_come_back_as_they_were(spark, frame, monkeypatch):
    monkeypatch.setattr(writers, "RECORDS_IN_FILE", 100)
    lines = [("Zoë  23  7",), ("",), (" " * 30,), ("x" * 70000,)] + [(f"{i:>5}",) for i in range(1000)]
    latin = frame([("é2",), ("Läst",)], "value string").select(F.encode("value", "ISO-8859-1").cast("string").alias("value"))
    for df, n in ((frame(lines, "value string").coalesce(1), 11), (latin.coalesce(1), 1), (frame([], "value string"), 1)):
        path = scratch_path(spark, "lines")
        writers.write_records(df, path)
        back = spark.read.text(path)
        # no file holds more lines than one task should read
        assert len(list(Path(path).glob("part-*"))) == n
        raw = F.col("value").cast("binary").alias("value")
        assert sorted(bytes(r.value) for r in back.select(raw).collect()) == sorted(bytes(r.value) for r in df.select(raw).collect())


@pytest.mark.parametrize("name, length", [("src_fixed_width_retake", 782), ("unmatched_ids", 740)])
def test_padding_of_records_takes_no_room(spark, tmp_path, name, length):
    n = 20000
    spark.range(n).selectExpr(
        "id as l_orderkey", "id * 7919 % 20000 as l_partkey", "id * 31 % 1000 as l_suppkey", "cast(1 + id % 7 as int) as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "1d as l_extendedprice", "0d as l_discount", "0.08d as l_tax", "'N' as l_returnflag",
        "'F' as l_linestatus", "timestamp_ntz'2017-02-01 00:00:00' + make_dt_interval(cast(id % 900 as int)) as l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    df = q.QUERIES[name](spark, str(tmp_path))
    assert df.count() == n
    assert sum(Path(f.removeprefix("file:")).stat().st_size for f in df.inputFiles()) < n * length / 4


def session_stub(master, checkpoint=None, **conf):
    core = SimpleNamespace(get=lambda k, d=None: conf.get(k, d))
    sc = SimpleNamespace(
        master=master, applicationId="stub", getConf=lambda: core, getCheckpointDir=lambda: checkpoint
    )
    return SimpleNamespace(conf=core, sparkContext=sc)


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(session_stub("yarn", **{"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"
    assert shared_dir(session_stub("yarn", "hdfs:///set/later")) == "hdfs:///set/later"
    with pytest.raises(RuntimeError):
        shared_dir(session_stub("yarn"))
    assert shared_dir(spark) == shared_dir(spark)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_cut_lineage_and_save_table(spark, frame):
    df = frame([(1, "a")], "i int, s string")
    assert cut_lineage(df).collect() == df.collect()
    path = scratch_path(spark, "tbl")
    assert save_table(df, path).collect() == df.collect()
    assert save_table(df.limit(0), path).count() == 0


def test_publish(spark, sf):
    out = scratch_path(spark, "publish")
    paths = publish(
        t.cohort(spark, sf), q.decoded(spark, sf), q.approved(spark, sf),
        t.school_names(spark, sf), t.system_names(spark, sf), out,
    )
    count = {n: spark.read.option("header", n not in ("students", "cube")).csv(p).count() for n, p in paths.items() if n not in ("students", "cube")}
    cube = spark.read.parquet(paths["cube"])
    assert count["base_file"] == cube.count()
    assert count["student_file"] == spark.read.parquet(paths["students"]).count()
    assert count["release_state"] == cube.where("level = 'state'").count()
    assert 0 < count["release_school"] < count["base_file"]
