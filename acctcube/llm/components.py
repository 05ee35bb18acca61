"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from acctcube.llm.common import discard, land


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``); root is the least node.

    Alternating stars: each node sends its larger neighbours to its least one, then its smaller
    ones. Every step is one grouped minimum (combined on the map side) and one join, which
    adaptive execution splits where a node is hot; no step gathers the neighbours of a node.
    Steps are landed, so a lost executor never repeats more than one.
    """
    now = land(_ordered(edges), "edges")
    while True:
        large = _star(now, larger=True)
        small = land(_star(large, larger=False), "edges")
        # a fixed point: each edge joins a node to a root, and no root is below another
        same = now.count() == small.count() and now.exceptAll(small).isEmpty()
        discard(now)
        now = small
        if same:
            break
    leaves = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = now.select(F.col("b").alias("node")).distinct().join(leaves, "node", "left_anti")
    return leaves.unionByName(roots.withColumn("root", F.col("node")))


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges, the larger end first."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """``edges`` has ``a > b``. Larger: neighbours above a node go to the least of it and its
    neighbours. Smaller: neighbours below a node, and the node, go to the least of them."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        to = edges.join(least, edges.a == least.n)
        out = to.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("n").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()
