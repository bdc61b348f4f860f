"""Connected components of a graph given as edges, by alternating large and small stars.

Every step replaces a node's edges by edges to its smallest neighbour; after a number of steps that grows with the logarithm of the
graph, each component is a star around its smallest node. A step is a partial minimum per node and a join with one row per node on
one side, so a node with very many neighbours can be split. Each step is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.operators.staging import Stage


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node (a > b) and its smaller neighbours go to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def stars(edges: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(a, b) for every node a of ``edges`` that is not the smallest, b, of its component."""
    now = stage.keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}_0")
    seen, step = None, 0
    while True:
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == seen:
            return now
        seen, step = sums, step + 1
        now = stage.keep(_small(_large(now)), f"{name}_{step}")
