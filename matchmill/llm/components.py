"""Connected components by alternating large-star and small-star steps, all as joins of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = cut_lineage(least.select("a", F.least("a", "least").alias("least")), "star")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = cut_lineage(edges.groupBy("a").agg(F.min("b").alias("least")), "star")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b")
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root: for each node of ``links`` (columns a, b) the smallest node it is connected with.

    Rounds run until the edges no longer change, in about log(nodes) of them. Each is written to
    the shared folder; what the driver sees is a count and a checksum. The least neighbours are
    written tables too, so that the join with a hot node's edges is one that Spark can split.
    Loops and nulls are ignored; repeated links count once; no links give no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges, "edges")
    before = _digest(edges)
    while before[0]:
        edges = cut_lineage(_small_star(cut_lineage(_large_star(edges), "edges")), "edges")
        now = _digest(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
