"""Connected components of a table of links, by alternating large and small stars.

Large star: every node tells its larger neighbours the smallest node it knows. Small star: every
node tells its smaller neighbours the same. Stars only, each around the smallest node of a
component, are left after a number of rounds that grows with the logarithm of the longest path.
Minima are combined before the shuffle, and a node with very many links is one side of an ordinary
join, which Spark can split; nothing is collected. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.session import written


def components(links: DataFrame) -> DataFrame:
    """``id, component``: for every node of ``links (a, b)`` the smallest node it is linked with.

    Links may repeat and point either way; links of a node with itself or with null are ignored.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = written(edges.distinct(), "links")
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "stars")
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has exactly one edge, to a smaller centre."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"))
    )
    nodes = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    wrong = (F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("least") == 0))
    return nodes.filter(wrong).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("_m"))
    least = least.select("u", F.least("u", "_m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    told = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), "m")
    return told.unionByName(least).select("u", F.col("m").alias("v")).distinct()
