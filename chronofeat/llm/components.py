"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch, attach


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node that it reaches.

    Each round hangs larger neighbours, then smaller ones, under the smallest node known. A node's
    minimum is combined before the shuffle, and goes back to the links by `attach`, so the links of
    a busy node stay where they are. Rounds grow with the logarithm of the longest path. Each round's edges are written to the shared folder; the
    round before last is deleted. No links give no rows; links to oneself and nulls are ignored.
    """
    scratch = Scratch(links.sparkSession, "components")
    edges = links.select(
        F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")
    ).where((F.col(a) != F.col(b)))
    edges = scratch.keep(edges.distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        large = scratch.keep(_large_star(edges, before[0]).distinct(), "large")
        new = scratch.keep(_small_star(large), "edges")
        scratch.drop(edges, large)
        edges, after = new, _digest(new)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("parent").alias("node")).distinct()
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("child", "parent").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame, number: int) -> DataFrame:
    """Every larger neighbour of a node hangs under the node's smallest neighbour or itself."""
    both = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionByName(
        edges.select(F.col("parent").alias("u"), F.col("child").alias("v"))
    )
    least = both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("links")
    )
    larger = both.where(F.col("v") > F.col("u"))
    hung = attach(larger, least, "u", "links", total=2 * number)
    return hung.select(F.col("v").alias("child"), F.col("m").alias("parent"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and all its smaller neighbours hang under the smallest of them."""
    least = edges.groupBy("child").agg(F.min("parent").alias("m"), F.count(F.lit(1)).alias("links"))
    moved = attach(edges, least, "child", "links").where(F.col("parent") != F.col("m"))
    moved = moved.select(F.col("parent").alias("child"), F.col("m").alias("parent"))
    own = least.select("child", F.col("m").alias("parent"))
    return moved.unionByName(own).distinct()
