"""Connected components of an undirected graph by alternating star operations.

Large-star hangs every larger neighbour of a node on the node's least neighbour, small-star
every smaller one; repeated in turn they end in one star a component, whose centre is its least
node.  Each step is a grouped minimum and a join, so a node of any degree is handled by partial
aggregation and by the engine's splitting of skewed joins; nothing is collected.  The edges of a
round are written once, by few tasks a core, as they are small beside what they link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import batches as B

TASKS_A_CORE = 4


def _hang(edges: DataFrame) -> DataFrame:
    """For directed (u, v): each v and u itself on the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def _kept(edges: DataFrame, name: str) -> DataFrame:
    cores = edges.sparkSession.sparkContext.defaultParallelism
    return B.saved(edges.where("u != v").distinct().coalesce(TASKS_A_CORE * cores), name)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u: then the v are centres."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
        .where("up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (columns u, v of a type with an order)."""
    edges = _kept(links.select("u", "v"), "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = _kept(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")),
                     "large-star")
        if _are_stars(down):
            edges = down
            break
        small = _hang(down)
        edges = _kept(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(small.select("u", F.col("m").alias("v"))), "small-star")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
