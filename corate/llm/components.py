"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are joined to the least of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are joined to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node that is not its own component.

    Alternates large-star and small-star steps until only stars are left, which takes
    a number of rounds logarithmic in the longest path.  Rows with a null end and
    loops are ignored.  A hub's edges are combined by a partial minimum; the joins
    are ones that Spark splits when skewed.  Each round is written to the shared folder.
    """
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialize(edges, "edges")
    while not _settled(edges):
        edges = materialize(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _settled(edges: DataFrame) -> bool:
    """Is every node joined to one other, which is joined to no smaller one?"""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    inner = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    return several.unionByName(inner).isEmpty()
