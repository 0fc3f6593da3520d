"""Connected components of an edge list by alternating large-star / small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014). A
round is two joins of the edge list against the smallest neighbour of each
node; the edges and labels stay distributed, the driver sees two numbers a
round. Both join inputs come from checkpoints, so each has its own exchange
and adaptive execution can split the partition of a node with many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import cut_lineage


def _smallest(edges: DataFrame) -> DataFrame:
    return cut_lineage(edges.groupBy("u").agg(F.min("v").alias("low"))
                       .select("u", F.least("u", "low").alias("low")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _smallest(both)
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest(down)
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = low.select("u", F.col("low").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that has an edge to another node.

    ``root`` is the smallest node of the component. Self-loops, repeated edges
    and edges with a null end are ignored; a node without any other edge does
    not appear. Empty input gives an empty result.
    """
    edges = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v")
                        .distinct())
    state = _state(edges)
    while state[0]:
        edges = cut_lineage(_large_star(edges))
        edges = cut_lineage(_small_star(edges))
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
