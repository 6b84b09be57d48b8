"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_checkpoint_dir


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest in its neighbourhood."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie every smaller neighbour of a node, and the node, to the smallest of them. Here u > v holds."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v) links of long ids to (id, component): each linked id with the smallest id it can reach.

    Two star contractions a round; the links of a round are written with
    checkpoint(), so lineage stays short and a lost executor costs one round.
    The rounds end when every tree is a star, after about log2 of the longest
    path; only two numbers a round reach the driver. Self links and repeated
    links do no harm; an empty table gives an empty result; null ends are
    dropped. Ids without links aren't returned.
    """
    with_checkpoint_dir(links.sparkSession)
    edges = (
        links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint()
    )
    while True:
        edges = _small_star(_large_star(edges)).checkpoint()
        # All are stars when no node is both a child and a parent, and no child has two parents.
        tops = edges.select(F.col("v").alias("u")).distinct()
        child_twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        if edges.join(tops, "u", "left_semi").select("u").unionByName(child_twice).isEmpty():
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
