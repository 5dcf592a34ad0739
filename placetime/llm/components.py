"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetime.session import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node's smaller neighbours and the node to the least of them. Edges run from large to small."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable from every node that has an edge, ``root`` excluded.

    ``edges`` has the columns u and v of one ordered type; loops and repeats are harmless.
    Both steps keep the components and shorten paths, so the rounds grow with the logarithm
    of the longest path. A star's centre is only ever grouped through partial minima. The
    edges of each round are checkpointed; the driver sees one row of totals per round.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = checkpointed(edges), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges, before = checkpointed(_small_star(_large_star(edges))), now
