"""Connected components of an undirected edge table, by alternating star contraction.

Each round is two joins-free aggregations with a neighbour join; the edge table never grows
beyond its first size, and rounds grow with the logarithm of the longest path. Rounds are
cut by tables written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MAX_ROUNDS = 50


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the vertex's least neighbour."""
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, is linked to the least one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex with an edge; a component is its least vertex.

    ``edges`` has two columns of comparable values; loops and repeats are allowed.
    """
    u, v = edges.columns
    now = materialize(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct(), "edges"
    )
    key = F.xxhash64("u", "v")
    seen = None
    for _ in range(MAX_ROUNDS):
        now = materialize(_small_star(_large_star(now)), "edges")
        # the edge table's count and sum of hashes: the same twice means nothing moved
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.shiftright(key, 20)), F.bit_xor(key)).first())
        if state == seen:
            return now.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("component")).union(
                now.select(F.col("v"), F.col("v")).distinct()
            )
        seen = state
    raise RuntimeError("components did not settle")
