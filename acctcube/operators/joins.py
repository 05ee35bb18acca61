"""Joins that match missing keys where asked and stay balanced on hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Places over which the rows with a missing key are spread.
SPREAD = 128


def attach(left: DataFrame, right: DataFrame, left_key: str, right_key: str, keys_present: bool = False) -> DataFrame:
    """Left join in which missing keys match each other; ``right_key`` is dropped.

    One plan at every size, no job while it is built, each table read once.  Rows of
    ``left`` with a missing key are spread by the partition they come from (a task that runs
    again chooses the same place), and the right rows with a missing key are repeated for
    each place.  Both sides are shuffled for this join
    alone, straight below it, so adaptive execution may split any other key that is hot in
    ``left`` between tasks.

    ``keys_present`` says that ``left`` has no missing key: a plain equi-join that keeps the
    partitioning (buckets, an earlier rank) of both sides.  A missing key is then an error.
    """
    right = right.withColumnRenamed(right_key, "_right_key")
    lk, rk = F.col(left_key), F.col("_right_key")
    if keys_present:
        # the partition's number keeps Spark from inferring the same of the right key
        wrong = F.raise_error(F.concat(F.lit(f"missing {left_key} in partition "), F.spark_partition_id()))
        present = left.where(F.when(lk.isNull(), wrong.cast("boolean")).otherwise(True))
        return present.join(right, lk == rk, "left").drop("_right_key")
    place = F.when(lk.isNull(), F.spark_partition_id() % SPREAD).otherwise(0)
    places = F.sequence(F.lit(0), F.when(rk.isNull(), SPREAD - 1).otherwise(0))
    spread = right.withColumn("_right_place", F.explode(places))
    same = lk.eqNullSafe(rk) & (F.col("_place") == F.col("_right_place"))
    joined = left.withColumn("_place", place).join(spread, same, "left")
    return joined.drop("_place", "_right_place", "_right_key")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` as it is, or an error where a key, also the missing one, has several rows.

    Spark plans the rank as a limit before the shuffle: a task sends at most two rows of a key.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0)))
    several = F.raise_error(F.lit(f"{key} repeats in a table that must have one row per key"))
    numbered = df.withColumn("_nth", nth).where(F.col("_nth") <= 2)
    return numbered.where(F.when(F.col("_nth") > 1, several.cast("boolean")).otherwise(True)).drop("_nth")


def attach_unique(left: DataFrame, right: DataFrame, left_key: str, right_key: str, keys_present: bool = False) -> DataFrame:
    """``attach`` to a table that must have at most one row per key; a repeated key is an error."""
    return attach(left, one_per_key(right, right_key), left_key, right_key, keys_present)


def _null_safe(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[v]) for k, v in keys.items()])


def full_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Full outer join on shared key names; missing keys match; shared value columns get suffixes."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared}).alias("a")
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in shared}).alias("b")
    cond = reduce(
        lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    )
    return a.join(b, cond, "full").select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys],
        *[F.col(f"a.`{c}`") for c in a.columns if c not in keys],
        *[F.col(f"b.`{c}`") for c in b.columns if c not in keys],
    )


def anti_join(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``left`` with no row of ``right`` equal on all pairs (left name -> right name)."""
    return left.join(right, _null_safe(left, right, keys), "left_anti")


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Left join to a lookup table; the planner broadcasts it only if its measured size allows."""
    return left.join(right, keys, "left")


def merge_status(left: DataFrame, right: DataFrame, left_key: str, right_key: str, key: str) -> DataFrame:
    """Full join with the match code: 1 only left, 2 only right, 3 both; missing keys match.

    The rows of ``left`` with their matches, then the rows of ``right`` without one.  The
    second part compares with the keys of ``left``, one row each, so a key that many rows
    share, the missing one too, is not brought to one task with all its rows.
    """
    flagged = right.withColumnRenamed(right_key, "_key").withColumn("_in_right", F.lit(True))
    matched = attach(left, flagged, left_key, "_key")
    status = F.when(F.col("_in_right"), 3).otherwise(1)
    rest = [F.col(f"`{c}`") for c in [*left.columns, *right.columns] if c not in (left_key, right_key)]
    first = matched.select(F.col(left_key).alias(key), *rest, status.cast("int").alias("merge_status"))
    seen = left.select(F.col(left_key).alias("_key")).distinct().withColumn("_in_left", F.lit(True))
    alone = attach(right, seen, right_key, "_key").where(F.col("_in_left").isNull())
    second = alone.select(F.col(right_key).alias(key), *[c for c in right.columns if c != right_key], F.lit(2).alias("merge_status"))
    return first.unionByName(second, allowMissingColumns=True)
