"""Connected components by alternating large and small stars.

Each round every node hands its larger neighbours to its smallest neighbour (large star),
then its smaller ones (small star); the edge list only shrinks towards stars around the
smallest node of each component. A node with very many neighbours is an aggregate and a
join, both split by Spark, never a list in one task. Rounds grow with the logarithm of
the number of nodes, and end when nothing but stars is left. Every round is written to the
shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, root) of every node with an edge in (a, b); root is the smallest node of its component.

    ``keep`` writes a round's edges (default: to a folder of their own).

    Loops, repeated and null edges are ignored; no edges give no rows.
    """
    keep = keep or (lambda df: stored(df, "edges"))
    edges = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not stars(edges):
        least = edges.union(edges.select("v", "u")).groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = keep(small.distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def stars(edges: DataFrame) -> bool:
    """Whether every node of the edges (u, v), u > v, is either a root (a ``v``) or in one edge: then each root is the
    smallest of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("many"), F.min("up").alias("least"))
    return not ends.agg(F.count_if((F.col("many") > 1) | (F.col("many") == 1) & (F.col("least") == 0))).first()[0]
