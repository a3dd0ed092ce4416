"""Connected components of an edge table by alternating large and small stars.

Every round is two grouped minima and joins; the edge table is written each
round, so nothing is collected and a lost executor costs one round. A star's
centre may have any number of neighbours: minima combine map-side and the
joins on a hot centre are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrecon.llm.util import remove, stored


def _large_star(e: DataFrame) -> DataFrame:
    """Each larger neighbour of a node meets the smallest of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours meet the smallest of them (edges run from larger ``u`` to smaller ``v``)."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that
    has an edge to another node. Self-links, repeats and both directions are
    harmless; edges with a null end are dropped; no edge gives no row."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = stored(e, "edges")
    digest = (F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
    seen = tuple(e.agg(*digest).first())
    while seen[0]:
        stars = stored(_large_star(e).distinct(), "large-star")
        after = stored(_small_star(stars).distinct(), "small-star")
        remove(stars)
        remove(e)
        now = tuple(after.agg(*digest).first())
        e, same = after, now == seen
        seen = now
        if same:
            break
    children = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return children.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
