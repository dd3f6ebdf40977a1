"""Connected components over an edge table, by alternating large-star and small-star steps.

Each step is a join of the edges with one minimum per node; no neighbour list is ever built, so a hub
with a third of all edges is rows of a skewed join (which AQE splits), not a group in one task.  Lineage
is cut after every round by a checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for every node of an edge between two nodes.

    NULL ends and loops are no edges; repeated edges count once; no edges give an empty result."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where("u > v").distinct().checkpoint()
    state = _state(e)
    while True:
        e = _small_star(_large_star(e)).checkpoint()
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
