"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.shared import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) from links (a, b) of longs; the root is the least node of a component.

    Nodes without links to others do not appear. Each round links the larger
    neighbours of every node, then the smaller ones, to the least of them, and
    is written to the shared folder; the number of rounds grows with the
    logarithm of the longest path. Rounds end when all links are stars: every
    node has one lesser neighbour, or none. Least neighbours are aggregated before
    the shuffle and joined back, so that a node with very many links is split.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        )
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = small.select(
            F.explode(
                F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))
            ).alias("x")
        ).select("x.u", F.col("x.m").alias("v"))
        edges = stored(small.where("u <> v").distinct(), "small-star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether no node of the distinct links (u, lesser v) has two lesser neighbours, or a lesser
    and a larger one."""
    ends = (F.struct("u", F.lit(1).alias("n")), F.struct(F.col("v").alias("u"), F.lit(0).alias("n")))
    nodes = (
        edges.select(F.explode(F.array(*ends)).alias("x"))
        .groupBy("x.u")
        .agg(F.sum("x.n").alias("lesser"), F.min("x.n").alias("least"))
    )
    between = (F.col("lesser") > 1) | ((F.col("lesser") == 1) & (F.col("least") == 0))
    return not nodes.agg(F.max(between)).first()[0]
