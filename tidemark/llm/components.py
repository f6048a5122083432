"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _least_neighbour(sides: DataFrame) -> DataFrame:
    return sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the least of its neighbours and itself."""
    sides = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return sides.join(_least_neighbour(sides), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node is either the middle of a star or a leaf with one edge."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up")).union(edges.select(F.col("v").alias("id"), F.lit(0).alias("up")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.min("up").alias("low")).where("up > 1 OR (up = 1 AND low = 0)").isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component: for each id in a link, the smallest id that links lead to.

    Loops and repeated links change nothing; a link with a null end is left out. No link, no row. Each round is written
    to the shared folder, so that a lost executor costs one round at most; only whether it was the last reaches the driver.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        if _stars(edges):
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
