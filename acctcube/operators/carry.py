"""Last value carried forward over a sorted table, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of the sketch for each range.
SKETCH = 20


def _place(columns: Sequence[str]) -> list[Column]:
    """Columns that compare like "ascending, missing last", as false is less than true."""
    return [x for c in columns for x in (F.col(c).isNull(), F.col(c))]


def carry_forward(
    df: DataFrame, order: Sequence[str], columns: Sequence[str], out: dict[str, str] | None = None
) -> DataFrame:
    """Fill each missing value with the last one before it in ascending order, missing keys last.

    Values before the first known one stay missing. Rows equal in the order go by their values,
    missing last, so what a row gets depends on its order columns and values alone: it is
    found once for each distinct choice of them and then joined to the rows, which are never
    gathered by a window, however many are equal.

    The distinct places are dealt in ranges whose bounds come from a sketch of them: the SKETCH * n
    places with the least hash, sorted, every SKETCH-th. The bounds are one value inside the same
    plan, a function of the places only, so each evaluation has the same ranges. Each
    range needs its own places and, from the ranges before it, one value per column: a table
    with one row per range. There are as many ranges as shuffle partitions.
    """
    out, spark = out or {}, df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*order, *columns]
    place = F.struct(*[x.alias(f"_{k}") for k, x in enumerate(_place(by))])
    places = df.groupBy(*by).agg(F.lit(1).alias("_one")).drop("_one").withColumn("_place", place)

    sketch = places.select("_place").orderBy(F.xxhash64("_place"), "_place").limit(SKETCH * ranges)
    every = F.filter(F.sort_array(F.collect_list("_place")), lambda p, i: (i > 0) & (i % SKETCH == 0))
    bounds = sketch.agg(every).scalar()
    bounded = places.withColumn("_bounds", bounds)
    ranged = bounded.withColumn("_range", F.size(F.filter("_bounds", lambda b: b <= F.col("_place")))).drop("_bounds")

    so_far = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    last = ranged.groupBy("_range").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_place"))).alias(c) for c in columns]
    )
    carried = last.select("_range", *[F.last(c, ignorenulls=True).over(before).alias(f"_before_{c}") for c in columns])
    filled = ranged.withColumns({f"_so_far_{c}": F.last(c, ignorenulls=True).over(so_far) for c in columns})
    # at most one row per range
    found = filled.join(F.broadcast(carried), "_range", "left").select(
        *[F.col(c).alias(f"_at_{c}") for c in by],
        *[F.coalesce(f"_so_far_{c}", f"_before_{c}").alias(f"_found_{c}") for c in columns],
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in by])
    named = df.join(found, same, "left").withColumns({out.get(c, c): F.col(f"_found_{c}") for c in columns})
    return named.drop(*[f"_at_{c}" for c in by], *[f"_found_{c}" for c in columns])
