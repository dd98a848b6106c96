"""Connected components of edge tables by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.storage import cut


def _least(edges: DataFrame) -> DataFrame:
    """Per ``u`` the smallest of itself and its ``v``: combined before the shuffle, so a hub costs one row a task."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    """Tells whether a round has changed a set of edges: their number and two sums of hashes."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(u, v)`` of a graph over longs to ``(node, component)``: the smallest node each node can reach.

    Nodes without an edge to another node do not appear. Every round writes its edges to the shared folder, which
    cuts the lineage and survives lost executors; a hub's edges are joined with a written table of minima, so that
    adaptive execution can split them. The number of rounds grows with the logarithm of the longest path.
    """
    edges = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(_least(both))
        large = cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = cut(_least(large))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
