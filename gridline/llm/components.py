"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over links (u, v) with u > v: neighbours are linked to the smallest around u.

    The minimum is combined before its shuffle; a node with very many links is a skewed key of the
    join, which adaptive execution splits.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    near = both.join(least, "u").withColumn("m", F.least("u", "m"))
    if large:
        pairs = F.array(F.struct(F.col("v"), F.col("m")))
        near = near.filter("v > u")
    else:
        pairs = F.array(F.struct(F.col("v"), F.col("m")), F.struct(F.col("u").alias("v"), F.col("m")))
    out = near.select(F.explode(pairs).alias("p")).select(F.col("p.v").alias("u"), F.col("p.m").alias("v"))
    return out.filter("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link at most, to a node that has none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.up").alias("ups"), F.count(F.lit(1)).alias("n"))
    return nodes.filter("ups > 1 or ups = 1 and n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node (other than that one) can reach.

    ``edges`` holds links (a, b) in any order, repeated or not. A large star links the larger
    neighbours of each node to the smallest one around it, a small star the smaller ones; both keep
    what is connected, and after about log(n) rounds all links are (node, root). Every step is
    written to the shared folder.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .filter("u <> v").distinct(), "links")
    while not _are_stars(e):
        e = stored(_star(e, True), "large-star")
        e = stored(_star(e, False), "small-star")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
