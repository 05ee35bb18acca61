"""Compare our aggregate with an independently made one.

Both tables are stacked with a mark of their side and counted by key and values. Rows that
are equal on both sides cancel there, already before the shuffle, and a key that many rows share,
the missing one too, is dealt by its values. Only what is left is paired by key; there is no
join of the two tables.

Tables with one row per key give what a full join on the keys gives, missing keys matching.
Where a key has several rows on a side, equal rows belong together and the others are paired
one to one in a fixed order, not each with each; rows that find no partner stay alone.
Copies of a row are one row with their number until the pairs are known.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from acctcube.functions import differs
from acctcube.operators.joins import anti_join

#: Parts into which the differing rows of one key are dealt.
PARTS = 64
#: Places of a key that are looked at together; with both sides, as many rows as a window keeps at hand.
BLOCK = 2048
_RUN = 4096


def _repeat(df: DataFrame, n: Column) -> DataFrame:
    """Each row ``n`` times, without an array of that length."""
    runs = df.withColumn("_n", n).withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _RUN))))
    here = F.least(F.lit(_RUN), F.col("_n") - F.col("_run") * _RUN)
    return runs.withColumn("_copy", F.explode(F.sequence(F.lit(1), here.cast("int")))).drop("_n", "_run", "_copy")


def _placed(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Where the ``_n`` copies of a row stand in its key and side: from ``_from`` to before ``_to``.

    Places are counted within parts of equal hash, part by part. A part of a hot key is sorted by
    itself; of each part only its size is looked at by the others.
    """
    in_key, in_part = [*keys, "_ours"], [*keys, "_ours", "_part"]
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*values), F.lit(PARTS)))
    sizes = dealt.groupBy(*in_part).agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*in_key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    starts = starts.select(*[F.col(c).alias(f"_of{c}") for c in in_part], "_before")
    in_order = Window.partitionBy(*in_part).orderBy(*values).rowsBetween(Window.unboundedPreceding, 0)
    counted = dealt.withColumn("_upto", F.sum("_n").over(in_order))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in in_part])
    to = F.col("_before") + F.col("_upto")
    return counted.join(starts, same).select(*keys, *values, "_ours", (to - F.col("_n")).alias("_from"), to.alias("_to"))


def _facing(placed: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of the two sides at the same places: ``keys``, ``_x``, ``_y`` and the number ``_n`` of such places.

    Copies are not made. The places of a key are cut into blocks of ``BLOCK``, so a block has few rows
    whatever the number of copies, and a hot key is spread over its blocks.
    """
    first, last = F.floor(F.col("_from") / BLOCK), F.floor((F.col("_to") - 1) / BLOCK)
    cut = placed.withColumn("_block", F.explode(F.sequence(first, last)))
    cut = cut.withColumn("_from", F.greatest("_from", F.col("_block") * BLOCK))
    in_block = Window.partitionBy(*keys, "_block").orderBy("_from")
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    row = F.struct("_to", F.struct(*values).alias("row"))
    held = [F.last(F.when(F.col("_ours") == own, row), True).over(upto).alias(name) for own, name in ((True, "_a"), (False, "_b"))]
    # up to the next row of either side the same two rows face each other, unless a side has ended
    until = F.coalesce(F.lead("_from").over(in_block), (F.col("_block") + 1) * BLOCK)
    steps = cut.select(*keys, "_from", until.alias("_until"), *held)
    ends = [F.greatest("_from", F.least(F.coalesce(f"{s}._to", "_from"), "_until")).alias(f"{s}_end") for s in ("_a", "_b")]
    steps = steps.select("*", *ends)
    x, y, a, b = F.col("_a.row"), F.col("_b.row"), F.col("_a_end"), F.col("_b_end")
    pair = F.struct(x.alias("_x"), y.alias("_y"), (F.least(a, b) - F.col("_from")).alias("_n"))
    alone = F.struct(F.when(a > b, x).alias("_x"), F.when(b > a, y).alias("_y"), F.abs(a - b).alias("_n"))
    return steps.select(*keys, F.inline(F.array(pair, alone))).where(F.col("_n") > 0)


def _paired(
    ours: DataFrame, theirs: DataFrame, keys: Sequence[str], columns: Mapping[str, str], equal: bool = True
) -> DataFrame:
    """The rows of ``paired``, equal ones once, with their number ``_n``."""
    keys, values = list(keys), list(columns)
    a = ours.select(*keys, *values, F.lit(True).alias("_ours"))
    b = theirs.select(*keys, *[F.col(t).alias(o) for o, t in columns.items()], F.lit(False).alias("_ours"))
    net = a.unionByName(b).groupBy(*keys, *values).agg(
        F.count_if("_ours").alias("_here"), F.count_if(~F.col("_ours")).alias("_there")
    )
    row, more = F.struct(*values), F.col("_here") - F.col("_there")
    left = net.where(more != 0).select(*keys, *values, (more > 0).alias("_ours"), F.abs(more).alias("_n"))
    pairs = _facing(_placed(left, keys, values), keys, values)
    if not equal:
        return pairs
    both = F.least("_here", "_there")
    return net.where(both > 0).select(*keys, row.alias("_x"), row.alias("_y"), both.alias("_n")).unionByName(pairs)


def paired(
    ours: DataFrame, theirs: DataFrame, keys: Sequence[str], columns: Mapping[str, str], equal: bool = True
) -> DataFrame:
    """``keys``, then ``_x`` and ``_y``: structs of our columns and of theirs under our names.

    ``_x`` is missing in a row of theirs alone and ``_y`` in one of ours. Without ``equal``
    the pairs of equal rows are left out.
    """
    return _repeat(_paired(ours, theirs, keys, columns, equal), F.col("_n"))


def reconcile_tolerance(
    ours: DataFrame, theirs: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 0.1
) -> DataFrame:
    """Rows where any shared column differs by more than the tolerance.

    Rows on one side only have a missing difference and fall out.
    """
    both = paired(ours, theirs, keys, {c: c for c in columns}, equal=False)
    far = [F.abs(F.col(f"_x.{c}") - F.col(f"_y.{c}")) > tolerance for c in columns]
    sides = [F.col(f"{s}.{c}").alias(f"{c}{s}") for s in ("_x", "_y") for c in columns]
    return both.where(reduce(lambda a, b: a | b, far)).select(*keys, *sides)


def reconcile_exact(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Rows of ours without a row of theirs equal in keys and values (ours -> theirs)."""
    return anti_join(ours, theirs, {**{k: k for k in keys}, **columns})


def reconcile_side_by_side(
    ours: DataFrame, theirs: DataFrame, keys: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """All rows of both, each of our columns next to theirs (ours -> theirs)."""
    both = paired(ours, theirs, keys, columns)
    return both.select(*keys, *[c for o, t in columns.items() for c in (F.col(f"_x.{o}").alias(o), F.col(f"_y.{o}").alias(t))])


def mismatch_counts(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per column, the number of rows that differ; two missing values are equal."""
    both = _paired(ours, theirs, keys, {c: c for c in columns}, equal=False)
    number = lambda c: F.sum(F.when(differs(F.col(f"_x.{c}"), F.col(f"_y.{c}")), F.col("_n")))
    counts = both.agg(*[F.coalesce(number(c), F.lit(0)).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_mismatch")) for c in columns])
    return counts.select(F.inline(rows))
