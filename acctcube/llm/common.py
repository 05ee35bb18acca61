"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acctcube.session import scratch_path
from acctcube.sources.store import Store

#: ASCII white space, as the word rule has it.
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows that a task holds as Python objects at a time.
SLICE = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` loops over it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs outside ASCII white space; none for a missing text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def id_bucket(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; missing for a missing id."""
    return F.crc32(F.col(column).cast("string")) % n


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint where it has at most ``max_rows`` rows, else as it is.

    ``df`` should be landed and its rows of bounded width; the result is the same either way,
    beyond the bound the planner shuffles.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def land(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    landed = df.sparkSession.read.schema(df.schema).parquet(path)
    landed._landed_at = path
    return landed


def land_mapped(df: DataFrame, name: str) -> DataFrame:
    """``land`` for a table that Python functions make: Spark sends them ``SLICE`` rows at a time at
    most, so neither side of the pipe holds a buffer of ten thousand texts. The setting is as it was
    afterwards; no result depends on it."""
    conf = df.sparkSession.conf
    was = conf.get(ARROW_ROWS)
    conf.set(ARROW_ROWS, str(min(int(was), SLICE) if int(was) > 0 else SLICE))
    try:
        return land(df, name)
    finally:
        conf.set(ARROW_ROWS, was)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, ``SLICE`` at a time at most."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            yield whole.slice(at, SLICE)


def discard(landed: DataFrame) -> None:
    """Delete a table of ``land`` whose readers have landed their own results."""
    Store(landed.sparkSession, landed._landed_at).delete("")


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """Each row as one struct ``_row`` beside ``columns`` under their names with ``_`` before
    them: whatever else the row holds, nothing in it can clash with an operator's columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    return docs.select(row, *(F.col(f"`{c}`").alias(f"_{c}") for c in columns))


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, value>>``, in code points.

    The pieces between matches and the matches alternate, so running sums of their lengths
    are the positions. Sums go by blocks, which keeps a text with many matches far from
    quadratic. ``pattern`` must not match an empty string.
    """

    def found(hits: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = let(gaps, lambda g: F.transform(hits, lambda m, i: F.length(g[i]) + F.length(m)))
        return let(
            let(steps, _running),
            lambda ends: F.transform(
                hits,
                lambda m, i: F.struct((ends[i] - F.length(m)).alias("start"), ends[i].alias("end"), m.alias("value")),
            ),
        )

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)


_BLOCK = 32


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _running(a: Column) -> Column:
    """Running sums of an integer array."""
    blocks = F.transform(
        F.filter(a, lambda x, i: i % _BLOCK == 0), lambda x, b: _total(F.slice(a, b * _BLOCK + 1, _BLOCK))
    )

    def sums(s: Column) -> Column:
        heads = F.transform(s, lambda x, b: _total(F.slice(s, 1, b)))
        return let(
            heads,
            lambda h: F.transform(
                a,
                lambda x, i: h[F.floor(i / _BLOCK).cast("int")]
                + _total(F.slice(a, i - i % _BLOCK + 1, i % _BLOCK + 1)),
            ),
        )

    return let(blocks, sums)
