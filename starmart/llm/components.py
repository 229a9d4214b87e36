"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import join_hot, keep


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
    least = least.select("node", F.least("node", "m").alias("m"))
    moved = join_hot(edges.select(F.col("lo").alias("node"), "hi"), least, "node")
    return moved.select("hi", F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and all its smaller neighbours on the smallest of these."""
    least = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
    met = join_hot(edges.select(F.col("hi").alias("node"), "lo"), least, "node")
    smaller = met.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return smaller.union(least.select(F.col("node").alias("hi"), F.col("m").alias("lo"))).distinct()


def _sum(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges; a single row per task is shuffled."""
    mixed = F.xxhash64("hi", "lo").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with an edge; root is the smallest reachable node.

    ``edges`` has two BIGINT columns in any order, repeated edges and loops
    allowed, NULLs not. Alternating large and small stars: each round rewires
    every edge towards smaller nodes and keeps components, until all are stars;
    rounds grow with the logarithm of the longest path. Every round is written to
    the shared folder, so a lost executor repeats one round at most. Nodes with
    very many neighbours are split by adaptive execution (``join_hot``).
    """
    a, b = (F.col(c) for c in edges.columns)
    now = keep(
        edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    before = _sum(now)
    while before[0]:
        now = keep(_small_star(_large_star(now)))
        after = _sum(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
