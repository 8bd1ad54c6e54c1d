"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node of its closed neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them (edges have a > b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` of longs -> ``(node, component)`` for nodes that have a link.

    ``component`` is the smallest node reachable.  Both steps are one grouped
    minimum and one equi-join, so a hub costs a partial aggregate per task and
    a skew-split join, never a collected neighbour list.  Every round is
    written to the shared folder; rounds grow with the logarithm of the
    component size.
    """
    edges = staged(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "cc")
    mark = _mark(edges)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        edges = staged(_small_star(_large_star(edges)), "cc")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
