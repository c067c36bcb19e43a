"""Connected components of a graph held as a table of edges.

Alternating large and small stars: each round ties a node's larger neighbours, then its smaller
ones, to the least of them, until every component is a star. Rounds grow with the logarithm of
the nodes. Minima are taken with map-side combining and joined back, so that a node with a large
part of all edges is split; every round is checkpointed, and one row per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.session import checkpointed, shuffles_go


def _stars(pairs: DataFrame) -> DataFrame:
    """``(u, v)`` with ``m``, the least of ``u`` and its partners."""
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return pairs.join(least, "u")


def _mark(edges: DataFrame) -> tuple:
    with shuffles_go(edges.sparkSession):
        return tuple(
            edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of an edge.

    Nodes are numbers. Loops, repeated edges and edges with a NULL end say nothing.
    """
    both = edges.where(F.col(a) != F.col(b))
    now = checkpointed(
        both.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        ways = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(ways).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = _stars(large.distinct())
        small = found.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = checkpointed(
            small.unionByName(found.select("u", F.col("m").alias("v"))).distinct()
        )
        before, mark, now = mark, _mark(following), following
        if mark == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
