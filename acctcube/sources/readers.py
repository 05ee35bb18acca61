"""Sources: delimited text, fixed-width text, landed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from acctcube.functions import to_number
from acctcube.session import scratch_path
from acctcube.sources.store import Commits
from acctcube.sources.writers import BOM

# (name, first byte, last byte, "text" | "number" | a Spark type name)
Field = tuple[str, int, int, str]


def _cells(spark: SparkSession, path: str, schema: StructType | str, sep: str) -> tuple[DataFrame, dict[str, Column], StructType]:
    """The text cells below ``path``, the wanted ones by their names, and the wanted types."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # without inference only the header line is looked at; all columns are text
    cells = spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    cells = cells.toDF(*[c.removeprefix(BOM) for c in cells.columns])
    names = {c.lower(): c for c in cells.columns}
    missing = [f.name for f in wanted if f.name.lower() not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    return cells, {f.name: F.col(f"`{names[f.name.lower()]}`") for f in wanted}, wanted


def read_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Delimited text, its columns found by their names in the header.

    The schema says which columns are wanted and their types, in any order; others are not read.
    Types are never inferred, a cell that does not hold its type becomes missing, and a
    wanted column that the header lacks is an error.  All files below ``path`` share a header.
    """
    cells, column, wanted = _cells(spark, path, schema, sep)
    return cells.select(*[column[f.name].try_cast(f.dataType).alias(f.name) for f in wanted])


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """``read_csv``, and beside it every cell that held something else than its type.

    The text is read once: rows and rejects are landed together and read back apart. Rejects are
    ``file, record, column_name, raw``; ``record`` counts the records of a file from 1, without the header.
    A file that is read in several blocks is counted by them: one row for each block is summed.
    """
    cells, column, wanted = _cells(spark, path, schema, sep)
    typed = {f.name: column[f.name].try_cast(f.dataType) for f in wanted}
    bad = [
        F.when(column[n].isNotNull() & c.isNull(), F.struct(F.lit(n).alias("column_name"), column[n].alias("raw")))
        for n, c in typed.items()
    ]
    landed_at = scratch_path(spark, "csv-checked")
    cells.select(
        F.struct(*[c.alias(n) for n, c in typed.items()]).alias("row"),
        F.array_compact(F.array(*bad)).alias("rejects"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    ).write.parquet(landed_at)
    landed = spark.read.parquet(landed_at)
    # records of a block have ids in a row
    blocks = landed.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    cell = F.explode("rejects").alias("cell")
    rejects = landed.where(F.size("rejects") > 0).select("file", "block", "id", cell).join(blocks, ["file", "block"])
    record = F.col("before") + F.col("id") - F.col("first") + 1
    return landed.select("row.*"), rejects.select("file", record.alias("record"), "cell.*")


def read_landed(spark: SparkSession, path: str, schema: StructType | str | None = None, version: int | None = None) -> DataFrame:
    """A typed table landed as Parquet.  A given schema saves reading the footers to plan.

    Of a table that ``save_table`` has replaced this is the last version, or the one asked for.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    commits = Commits(spark, path)
    number = commits.last() if version is None else version
    if number:
        return reader.parquet(*[commits.store.at(f) if f else path for f in commits.load(number)["folders"]])
    return reader.parquet(path)


def record_status(value: str, layout: Sequence[Field]) -> Column:
    """``ok``, or why a record is not as long as its layout: ``blank``, ``short``, ``long``."""
    n, last = F.length(F.col(value).cast("binary")), max(b for _, _, b, _ in layout)
    blank = F.length(F.trim(F.col(value))) == 0
    return F.when(blank, "blank").when(n < last, "short").when(n > last, "long").when(n == last, "ok")


def decode_fixed_width(
    lines: DataFrame, layout: Sequence[Field], value: str = "value", charset: str = "UTF-8", status: str | None = None
) -> DataFrame:
    """Cut records by byte range, each field in ``charset``.

    Text fields are trimmed and a blank one is empty text; a field that lies behind the end of
    its record is empty too, and the column named by ``status`` tells short from blank records.
    A number field that does not hold a number becomes missing.
    """
    raw = F.col(value).cast("binary")

    def cell(first: int, last: int, kind: str) -> Column:
        part = F.substring(raw, first, last - first + 1)
        text = F.trim(part.cast("string") if charset == "UTF-8" else F.decode(part, charset))
        if kind == "text":
            return text
        return to_number(text, "double" if kind == "number" else kind)

    told = [record_status(value, layout).alias(status)] if status else []
    return lines.select(*[cell(a, b, kind).alias(name) for name, a, b, kind in layout], *told)


def read_fixed_width(
    spark: SparkSession, path: str, layout: Sequence[Field], charset: str = "UTF-8", status: str | None = None
) -> DataFrame:
    """Records of lines; the bytes of a line are kept as they are until its fields are cut."""
    return decode_fixed_width(spark.read.text(path), layout, charset=charset, status=status)


def read_in_order(rows: DataFrame, position: str) -> DataFrame:
    """Rows just read from files, numbered from 0 in order of the file names and of their lines.

    For what ``write_csv`` or ``in_order`` sorted. The numbers of a file's rows are counted within
    its blocks; only one row for each block goes through a window.
    """
    held = rows.columns
    placed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in held]).alias("row"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    blocks = placed.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("id") - F.col("first")
    return placed.join(blocks, ["file", "block"]).select("row.*", number.alias(position))
