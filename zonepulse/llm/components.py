"""Connected components of a link table by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from zonepulse.session import materialize

MOST_ROUNDS = 60        # each about halves the longest path


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable by links, for every node of a link between two nodes.

    A large star ties every larger neighbour of a node to the node's least neighbour, a small star
    every smaller one; both keep the components and end in stars around the least nodes. Minima are
    aggregated before they are joined back, so a node with most of the links is no single task's work. Repeated links
    do no harm and go where a round ends.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v")), "links")
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct())
        edges = materialize(small, "stars")
        if _stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError("components did not settle")


def _stars(edges: DataFrame) -> bool:
    """Whether different links (u, v), v the smaller, are stars around least nodes: who has a smaller neighbour has no other one."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    other = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1")
    return other.agg(F.count("*")).first()[0] == 0
