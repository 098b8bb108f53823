"""Connected components of a large edge list, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import Tables


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours of a node are tied to the least of them.

    Large stars move only neighbours above the node, small stars those below,
    so a node's degree never forces its neighbours through one task's memory:
    the least is a map-side aggregate, the rest a join on the node.
    """
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = near.join(least, "u")
    if large:
        out = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is its least node.

    Self-loops and repeated edges do no harm.  Every round is a written table;
    it ends when a round changes nothing, after about log of the longest path.
    """
    now = tables.settle(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    mark = None
    while True:
        before = now
        now = tables.settle(_star(_star(before, True), False))
        tables.drop(before)
        row = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()
        if (row.n, row.h) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark = (row.n, row.h)
