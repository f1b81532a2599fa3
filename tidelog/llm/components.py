"""Connected components of an edge table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node among it and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; edges point from larger to smaller."""
    least = _least(edges)
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _unsettled(edges: DataFrame) -> int:
    """Nodes that still point to a node which points further, or to more than one node."""
    several = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    through = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").select("u")
    return several.union(through).limit(1).count()


def components(edges: DataFrame, source: str = "u", target: str = "v") -> DataFrame:
    """Node and root (its component's smallest node) for each node that has an edge to another one.

    Each round cuts the paths to the smallest node by a constant factor and is written to the shared folder, so a
    lost executor costs one round at most. Nodes with a null end or an edge to themselves alone are left out.
    """
    u, v = F.col(source).cast("long"), F.col(target).cast("long")
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    now = materialize(now.where(u.isNotNull() & v.isNotNull() & (u != v)).distinct(), "edges")
    while _unsettled(now):
        now = materialize(_small_star(_large_star(now)).distinct(), "edges")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
