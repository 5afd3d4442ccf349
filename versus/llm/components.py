"""Connected components of an edge table as DataFrame rounds.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014).  Minima are ordinary aggregates
(combined before the shuffle) that are joined back, so a node with very many
neighbours is never gathered; every round is cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge: the component is its smallest node.

    Null ends, loops and repeated edges have no effect; without edges the result is empty.
    """
    e = (edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = cut_lineage(e)
    before = _state(e)
    while before[0]:
        e = cut_lineage(_small_star(_large_star(e).distinct()).distinct())
        now = _state(e)
        if now == before:
            break
        before = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
