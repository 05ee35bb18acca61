"""Saved, published, named, ordered and checked files."""

import json

import pytest
from pyspark.sql import functions as F

from acctcube.plans import publish as pb
from acctcube.session import scratch_path
from acctcube.sources import (
    CommitConflict,
    read_csv,
    read_csv_checked,
    read_fixed_width,
    read_in_order,
    read_landed,
    save_table,
    write_csv,
    write_named,
)
from acctcube.sources.store import Commits, Store
from acctcube.sources.writers import finish_named
from acctcube.suite import queries as q, tables as t


def ids(df):
    return sorted(r.i for r in df.collect())


# ---- saved tables ----------------------------------------------------------


def test_save_over_what_is_read(spark):
    path = scratch_path(spark, "tbl")
    save_table(spark.range(5).withColumnRenamed("id", "i"), path)
    for k in range(3):
        save_table(read_landed(spark, path).withColumn("i", F.col("i") + 10), path)
    assert ids(read_landed(spark, path)) == [30, 31, 32, 33, 34]
    # the version before can still be read, older ones are gone
    assert Commits(spark, path).numbers() == [3, 4]
    assert ids(read_landed(spark, path, version=3)) == [20, 21, 22, 23, 24]
    assert len(Store(spark, path).names("_data")) == 2


def test_plain_folder_is_the_first_version(spark):
    path = scratch_path(spark, "plain")
    spark.range(3).withColumnRenamed("id", "i").write.parquet(path)
    assert ids(read_landed(spark, path)) == [0, 1, 2]
    save_table(read_landed(spark, path).withColumn("i", F.col("i") * 2), path)
    assert ids(read_landed(spark, path)) == [0, 2, 4] and ids(read_landed(spark, path, version=1)) == [0, 1, 2]
    save_table(read_landed(spark, path).withColumn("i", F.col("i") + 1), path)
    assert ids(read_landed(spark, path)) == [1, 3, 5]
    assert [n for n in Store(spark, path).names() if not n.startswith(("_", "."))] == []


def test_failed_save_leaves_the_old_rows(spark):
    path = scratch_path(spark, "fails")
    save_table(spark.range(0, 1000, 1, 4).withColumnRenamed("id", "i"), path)
    # one task fails after others have written
    broken = F.when(F.col("i") == 990, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("i"))
    with pytest.raises(Exception, match="broken"):
        save_table(read_landed(spark, path).withColumn("i", broken), path)
    assert ids(read_landed(spark, path)) == list(range(1000))
    save_table(read_landed(spark, path).where("i < 3"), path)
    assert ids(read_landed(spark, path)) == [0, 1, 2]


def test_second_of_two_writers_is_refused(spark, monkeypatch):
    path = scratch_path(spark, "two")
    save_table(spark.range(1).withColumnRenamed("id", "i"), path)
    first = Commits(spark, path)
    base = first.last()
    save_table(spark.range(2).withColumnRenamed("id", "i"), path)
    with pytest.raises(CommitConflict):
        first.commit(base, {"folders": []})
    # also where the other commit comes between the look and the rename
    monkeypatch.setattr(Commits, "last", lambda self: base)
    with pytest.raises(CommitConflict):
        first.commit(base, {"folders": []})
    monkeypatch.undo()
    assert ids(read_landed(spark, path)) == [0, 1]
    assert [n for n in Store(spark, path).names("_commits") if not n.isdigit() and "crc" not in n] == []


def test_reader_of_the_last_version_is_not_disturbed(spark):
    path = scratch_path(spark, "reader")
    save_table(spark.range(3).withColumnRenamed("id", "i"), path)
    reading = read_landed(spark, path)
    save_table(spark.range(1).withColumnRenamed("id", "i"), path)
    assert ids(reading) == [0, 1, 2]
    with pytest.raises(ValueError):
        save_table(reading, path, keep=1)


# ---- published runs --------------------------------------------------------


def run(spark, sf, out, **kw):
    return pb.publish(
        t.cohort(spark, sf), q.decoded(spark, sf), q.approved(spark, sf), t.school_names(spark, sf), t.system_names(spark, sf), out, **kw
    )


def test_failed_run_shows_nothing(spark, sf, monkeypatch):
    out = scratch_path(spark, "runs")
    with pytest.raises(FileNotFoundError):
        pb.published(spark, out)
    first = run(spark, sf, out, stamp="day1")
    assert pb.published(spark, out) == first
    assert {p.rsplit("/", 1)[1] for p in first.values()} == {f"{n}_day1" for n in (*pb.TABLES, *pb.ORDERS)}
    before = {n: spark.read.text(p).count() for n, p in first.items() if n in pb.ORDERS}

    written, write = [], pb.write_csv

    def failing(df, path, **kw):
        written.append(path)
        if len(written) == 3:  # the fifth output
            raise OSError("disk full")
        write(df, path, **kw)

    monkeypatch.setattr(pb, "write_csv", failing)
    with pytest.raises(OSError):
        run(spark, sf, out, stamp="day2")
    monkeypatch.undo()
    assert pb.published(spark, out) == first
    assert {n: spark.read.text(p).count() for n, p in first.items() if n in pb.ORDERS} == before
    with pytest.raises(FileExistsError):
        run(spark, sf, out, mode="error")


def test_releases_are_in_order(spark, sf):
    out = scratch_path(spark, "runs")
    paths = run(spark, sf, out)
    for name, keys in pb.ORDERS.items():
        rows = read_in_order(spark.read.option("header", True).csv(paths[name]), "at").orderBy("at").select(*keys).collect()
        # keys are numbers but for the subgroup; missing last
        def place(r, keys=keys):
            return [(v is None, v if k.lower() == "subgroup" else int(v or 0)) for k, v in zip(keys, r, strict=True)]

        assert rows and [place(r) for r in rows] == sorted(map(place, rows))


# ---- named files -----------------------------------------------------------


def test_named_files_and_hot_key(spark, frame):
    rows = [("a/b c", i) for i in range(2000)] + [("x", 1), ("x", 2), (None, 3), ("{key}", 4)]
    df, path = frame(rows, "k string, v int"), scratch_path(spark, "named")
    files = write_named(df, path, "k", "report_{key}.csv", bom=True, max_records_per_file=500)
    assert len(files["a/b c"]) >= 4 and files["x"] == ["report_x.csv"] and files["missing"] == ["report_missing.csv"]
    assert all(n.startswith("report_a%2Fb c_") for n in files["a/b c"])
    store = Store(spark, path)
    assert store.names() == sorted([n for names in files.values() for n in names] + ["_data"])
    back = read_csv(spark, path, df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert [r.v for r in read_csv(spark, store.at("report_x.csv"), df.schema).orderBy("v").collect()] == [1, 2]
    with pytest.raises(Exception, match="exists"):
        write_named(df.where("k = 'x'"), path, "k", "report_{key}.csv")


def test_naming_goes_on_after_a_break(spark, frame, monkeypatch):
    df, path = frame([(i % 5, i) for i in range(50)], "k int, v int"), scratch_path(spark, "named")
    moves, move = [], Store.move

    def failing(self, old, new):
        moves.append(new)
        if len(moves) == 3:
            raise OSError("gone")
        move(self, old, new)

    monkeypatch.setattr(Store, "move", failing)
    with pytest.raises(OSError):
        write_named(df, path, "k", max_records_per_file=4)
    monkeypatch.undo()
    store = Store(spark, path)
    (staged,) = store.names("_data")
    files = finish_named(store, f"_data/{staged}")
    assert all(len(names) == 3 for names in files.values()) and len(files) == 5
    back = read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


# ---- order, rejects, fixed width -------------------------------------------


def test_ordered_files(spark, frame):
    df = frame([(None if i % 10 == 3 else (i * 37) % 101, i) for i in range(1000)], "k int, v int").repartition(5)
    path = scratch_path(spark, "ordered")
    with_parts = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in with_parts.items():
        spark.conf.set(k, v)
    try:
        write_csv(df, path, order=["-k", "v"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.option("header", True).schema("k int, v int").csv(path)
    assert len(back.inputFiles()) > 1
    rows = read_in_order(back, "at").orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(1000))
    expect = sorted(df.collect(), key=lambda r: (r.k is None, -(r.k or 0), r.v))
    assert [(r.k, r.v) for r in rows] == [tuple(r) for r in expect]


def test_rejected_cells(spark, frame):
    path = scratch_path(spark, "rejects")
    lines = ["id,score,day", "1,20,2017-01-31", "2,x,2017-02-30", ",21,", "4, 7 ,soon", "zz,,2017-03-01"]
    frame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows, rejects = read_csv_checked(spark, path, "day date, id bigint, score int")
    assert [r.id for r in rows.collect()] == [1, 2, None, 4, None]
    assert sorted((r.record, r.column_name, r.raw) for r in rejects.collect()) == [
        (2, "day", "2017-02-30"), (2, "score", "x"), (4, "day", "soon"), (5, "id", "zz"),
    ]
    assert {r.file for r in rejects.collect()} == {Store(spark, path).names()[-1]}


def test_rejects_of_a_file_in_blocks(spark, frame):
    path = scratch_path(spark, "blocks")
    frame([("n,v",)] + [(f"{i},{'bad' if i % 100 == 0 else i}",) for i in range(1, 5001)], "value string").coalesce(1).write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows, rejects = read_csv_checked(spark, path, "n int, v int")
        assert rows.count() == 5000
        assert sorted(r.record for r in rejects.collect()) == list(range(100, 5001, 100))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fixed_width_charset_and_status(spark):
    layout = [("name", 1, 4, "text"), ("n", 5, 6, "int")]
    path = scratch_path(spark, "latin")
    lines = ["Zoë 12", "Zoë 1", "Zoë", "", "      ", "Zoë 123", "Zoë xx", "    "]
    encoded = spark.createDataFrame([(x,) for x in lines], "s string").select(F.encode("s", "ISO-8859-1").cast("string"))
    encoded.coalesce(1).write.text(path)
    got = sorted(map(tuple, read_fixed_width(spark, path, layout, charset="ISO-8859-1", status="why").collect()), key=str)
    assert got == sorted(
        [("Zoë", 12, "ok"), ("Zoë", 1, "short"), ("Zoë", None, "short"), ("", None, "blank"), ("", None, "blank"),
         ("Zoë", 12, "long"), ("Zoë", None, "ok"), ("", None, "blank")], key=str)
    # without a status the columns are those of the layout
    assert read_fixed_width(spark, path, layout).columns == ["name", "n"]


def test_commits_hold_json(spark):
    path = scratch_path(spark, "commits")
    save_table(spark.range(1), path)
    text = Store(spark, path).read("_commits/00000001")
    assert list(json.loads(text)) == ["folders"]
