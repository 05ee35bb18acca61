"""Sinks: CSV, lines of records, one CSV folder or named file per key value, landed tables that can be replaced."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F

from acctcube.operators.best import Order, sort_columns
from acctcube.sources.store import Commits, Store

BOM = "\ufeff"
#: Lines in a file of ``write_records`` at most.
RECORDS_IN_FILE = 250_000


def in_order(df: DataFrame, order: Order) -> DataFrame:
    """``df`` dealt in ranges of the order and sorted in each, missing last.

    Part files are numbered by range, so their rows in order of the file names are the sorted
    table, and no task sees more than its range. Adaptive execution may join neighbouring ranges.
    """
    by = sort_columns(order)
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def write_csv(df: DataFrame, path: str, bom: bool = False, mode: str = "error", order: Order = ()) -> None:
    """CSV with a header, missing values empty, rows sorted over all files if there is an order.

    ``bom`` marks every part file as UTF-8 for spreadsheet programs by putting the
    mark in front of the first header cell.
    """
    if order:
        df = in_order(df, order)
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    (
        df.write.mode(mode)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def write_records(lines: DataFrame, path: str, mode: str = "error") -> None:
    """Lines such as fixed-width records, their bytes kept as they are, compressed as they are written.

    Most of a fixed-width record is padding. A compressed file is read by one task, so no file holds
    more than ``RECORDS_IN_FILE`` lines. ``read_fixed_width`` reads them back.
    """
    (
        lines.write.mode(mode)
        .option("compression", "lz4")
        .option("maxRecordsPerFile", RECORDS_IN_FILE)
        .text(path)
    )


def write_split(
    df: DataFrame,
    path: str,
    key: str,
    bom: bool = False,
    max_records_per_file: int = 0,
    mode: str = "error",
) -> None:
    """One folder per value of ``key``, in one pass over the data; the key stays in the files.

    The rebalance hint gathers the rows of small keys into one task each and lets
    adaptive execution cut a hot key into several, so no key is written by a single
    task only because it is large.
    """
    folder = f"{key}_is"
    out = df.withColumn(folder, F.col(key)).hint("rebalance", F.col(folder))
    if bom:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    (
        out.write.mode(mode)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(folder)
        .csv(path)
    )


def write_named(
    df: DataFrame,
    path: str,
    key: str,
    name: str = "{key}.csv",
    bom: bool = False,
    max_records_per_file: int = 0,
    missing: str = "missing",
) -> dict[str, list[str]]:
    """One CSV file per value of ``key``, called by ``name``; the key stays in the files.

    All files are written in one pass into a folder that readers pass over, and are then renamed
    one by one. A key whose rows were too many for one task has several parts, which
    are numbered: ``name_1.csv``, ``name_2.csv``. An existing file of that name is an error. Returns
    the file names of each key, as text; characters that a file name cannot hold are escaped
    in it. If the renaming is broken off, calling ``finish_named`` goes on with it.
    """
    store = Store(df.sparkSession, path)
    staged = Commits(df.sparkSession, path).new_folder()
    write_split(df, store.at(staged), key, bom, max_records_per_file)
    return finish_named(store, staged, name, missing)


def finish_named(store: Store, staged: str, name: str = "{key}.csv", missing: str = "missing") -> dict[str, list[str]]:
    """Give the files below ``staged`` their names.

    The names are written down before the first file is renamed, so that a second call finds the
    same ones and goes on where the first one broke off. Only names come to the driver.
    """
    plan_file, stem, end = f"{staged}/_names", *name.rsplit(".", 1)
    if store.exists(plan_file):
        plan = json.loads(store.read(plan_file))
    else:
        plan = {}
        for folder in (n for n in store.names(staged) if "=" in n):
            escaped = folder.split("=", 1)[1]
            escaped = missing if escaped == "__HIVE_DEFAULT_PARTITION__" else escaped
            parts = [p for p in store.names(f"{staged}/{folder}") if p.startswith("part-")]
            marks = [""] if len(parts) == 1 else [f"_{k}" for k in range(1, len(parts) + 1)]
            named = [f"{stem}{mark}.{end}".replace("{key}", escaped) for mark in marks]
            plan[unquote(escaped)] = [[f"{staged}/{folder}/{part}", new] for part, new in zip(parts, named, strict=True)]
        store.write(plan_file, json.dumps(plan))
    for moves in plan.values():
        for old, new in moves:
            if store.exists(old):
                store.move(old, new)
    store.delete(staged)
    return {key: [new for _, new in moves] for key, moves in plan.items()}


def save_table(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Write a landed table, replacing what is there, and read it back.

    The rows go to a new folder below ``path`` and count from the moment the commit for them
    appears (``sources.store``). So ``df`` may read the table it replaces, a job that fails leaves
    the old rows, and whoever reads the last version meanwhile can go on: ``keep`` versions stay.
    A plain Parquet folder at ``path`` is the first version. The written table ends
    the lineage: later stages restart from it.
    """
    if keep < 2:
        raise ValueError("the version that is read must outlive its replacement")
    spark, commits = df.sparkSession, Commits(df.sparkSession, path)
    before, folder = commits.last(), commits.new_folder()
    if not before and commits.store.names():
        # a plain folder: its files become the version to go back to
        before = commits.commit(0, {"folders": [""]})
    df.write.parquet(commits.store.at(folder))
    commits.commit(before, {"folders": [folder]})
    commits.keep(keep)
    return spark.read.schema(df.schema).parquet(commits.store.at(folder))


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Land a table bucketed and sorted by ``key``.

    Attempts and cohorts landed with the same key and bucket count are ranked and
    joined without a shuffle, every time they are used.
    """
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
