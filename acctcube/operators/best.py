"""Best record per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# An order is a list of names; a leading "-" means descending.  Missing values
# come last in both directions.
Order = Sequence[str]

SCORE_FIRST: Order = [
    "-composite",
    "-math",
    "-reading",
    "-english",
    "-science",
    "-test_date",
    "file",
]
SUBJECT_FIRST: Order = ["-composite", "-english", "-math", "-reading", "-science"]


def sort_columns(order: Order) -> list[Column]:
    return [F.desc_nulls_last(n[1:]) if n.startswith("-") else F.asc_nulls_last(n) for n in order]


def best_record(attempts: DataFrame, key: str, order: Order = SCORE_FIRST) -> DataFrame:
    """The first row per id in the order, missing cells included.

    Ids that are missing form one group.  The rank filter is planned as a group
    limit on both sides of the shuffle, so each map task sends at most one row
    per id and a hot id costs one row per task.
    """
    in_order = Window.partitionBy(key).orderBy(*sort_columns(order))
    return attempts.withColumn("_rank", F.row_number().over(in_order)).where("_rank = 1").drop("_rank")


_INVERTED = ("0123456789ABCDEF", "FEDCBA9876543210")


def _largest_first(df: DataFrame, name: str) -> Column:
    """An expression that is the larger, the earlier a row comes; missing where ``name`` is."""
    if name.startswith("-"):
        return F.col(name[1:])
    col, kind = F.col(name), df.schema[name].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        # not the negative, which the least integer does not have
        return F.bitwise_not(col)
    if kind in ("float", "double", "decimal"):
        return -col
    if kind == "boolean":
        return ~col
    if kind == "date":
        return -F.unix_date(col)
    if kind in ("timestamp", "timestamp_ntz"):
        return -F.unix_micros(col.cast("timestamp"))
    if kind in ("string", "binary"):
        # the mark after the last byte puts a text before the longer ones it begins
        return F.concat(F.translate(F.hex(col), *_INVERTED), F.lit("G"))
    raise TypeError(f"cannot order by {name}, a {kind}")


def first_nonmissing(attempts: DataFrame, key: str, order: Order, columns: Sequence[str]) -> DataFrame:
    """Per id and column, the first value in the order that is not missing.

    A result row may therefore mix attempts.  Order columns go up or down ("-") as they like,
    missing last; of rows equal in the order the larger value counts.  The order is made one
    value that an aggregate can compare, so it combines on the map side and no group is gathered whole.
    """
    # in a struct comparison a missing field is the smallest, so "largest first"
    # also puts missing last
    rank = [_largest_first(attempts, n) for n in order]

    def pick(c: str) -> Column:
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*rank, F.col(c)))).alias(c)

    return attempts.groupBy(key).agg(*[pick(c) for c in columns])


def first_rows(df: DataFrame, n: int, order: Order) -> DataFrame:
    """The first ``n`` rows in the order, missing last; rows equal in it go by the other columns, ascending.

    Every task hands on its own first ``n`` rows at most.
    """
    named = [c.removeprefix("-") for c in order]
    rest = [f.name for f in df.schema if f.name not in named and f.dataType.typeName() not in ("map", "variant")]
    return df.orderBy(*sort_columns(order), *[F.asc_nulls_last(f"`{c}`") for c in rest]).limit(n)
