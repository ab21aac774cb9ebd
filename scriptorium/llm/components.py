"""Connected components of large edge tables: alternating large-star and small-star steps.

Every step gives each node's neighbours the smallest node known nearby and drops repeated edges; when a round
changes nothing, each edge leads from a node to the smallest node of its component. A hub's edges are only
ever joined by broadcast (common.lookup) or reduced to a minimum before the shuffle. Nodes are never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _hung(edges: DataFrame, keep, total: int) -> DataFrame:
    """For edges (u, v), total in number: v and u below the smallest of u and its neighbours, of those edges that keep lets through."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return common.lookup(edges, least, "u", "n", total).where(keep)


def labels(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of edges (u, v), bigint."""
    at = common.cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    n, seen = at.count(), None
    while True:
        before = at
        both = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both, F.col("v") > F.col("u"), 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        if n > common.LOOKUP_ROWS:  # it is read several times
            large = common.cut(large, "large")
        down = _hung(large, F.lit(True), n)
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        at = common.cut(small.where("u <> v").distinct(), "edges")
        common.drop(edges.sparkSession, before._cut_to, *([large._cut_to] if n > common.LOOKUP_ROWS else []))
        now = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        n, seen = now[0], now
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")).union(at.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
