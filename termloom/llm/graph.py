"""Connected components of an edge table, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_smallest(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    mins = _smallest(edges)
    hung = edges.join(mins, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(mins.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b) of whole numbers.

    A component is named after its smallest node. Alternating large and small stars;
    each round is written to the shared folder, so lost executors cost one round.
    Edges with a null or two equal ends are passed over. No edges: an empty table.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "edges")
    seen = _print(edges)
    while seen[0]:
        edges = stage(_small_star(_large_star(edges).distinct()), "edges")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
