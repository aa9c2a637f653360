"""Connected components of a table of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import save


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component for every end of a link; component is the smallest node that can be reached.

    Each round hooks every node's larger neighbours to its smallest one, then every node's smaller
    neighbours: the number of links never grows, and long chains halve. Links that make a star around
    the smallest node of a component no longer change, and end the rounds. No task sees a node's links
    as a list; minima are taken before the shuffle and joined back by sort-merge, where a node with very
    many links can be split.
    """
    edges = save(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    while not _stars(edges):
        edges = save(_star(save(_star(edges, larger=True)), larger=False))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return save(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots))


def _stars(edges: DataFrame) -> bool:
    """Every node is the end of one link, or the smaller node of all of its own: each component is a star around its smallest."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("low")))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low")).filter("up > 1 or up = 1 and low = 1")
    return odd.isEmpty()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: neighbours above a node go to its smallest neighbour; small star: those below, and itself."""
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.join(low, both.u == low.w).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        near = edges.join(low, edges.u == low.w).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = near.unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()
