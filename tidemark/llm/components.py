"""Connected components of a link table by alternating stars; no node's links are gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour, or to itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Edges have u > v."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u")
    up = moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every linked node but the roots: the smallest node it is connected to.

    Each round is two joins on grouped minima; the number of rounds grows with the logarithm
    of the longest chain. Minima are written before the join, so that both of its sides are
    shuffled for it and the links of a node with very many can be split.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        last, state = state, _state(edges)
        if state == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
