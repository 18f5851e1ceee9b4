"""Connected components of an edge table by alternating stars.

Every step is a shuffle over edges; no node's neighbours are ever gathered in one place.
"Large star" hooks the larger neighbours of a node to its smallest neighbour, "small
star" the smaller ones. Both keep components, and they end in one star per component, in
a number of rounds that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.durable import durable


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger u, smaller v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    hooked = edges.join(least, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hooked.unionAll(least.select("u", F.col("least").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node reachable.

    Self loops and repeated edges are allowed; no edges give no rows.
    """
    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    stars = durable(edges.where("u <> v").select(larger.alias("u"), smaller.alias("v")).distinct(), "edges")
    state = None
    while True:
        seen = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state or seen[0] == 0:
            break
        state = tuple(seen)
        stars = durable(_small_star(_large_star(stars)), "stars")
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
