"""Connected components of links between long ids, by alternating stars over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace


def connected_components(links: DataFrame, work: Workspace, name: str = "links") -> DataFrame:
    """`node` and `root` (its component's smallest node) for all nodes of `links` (`a`, `b`), except roots themselves.

    Each round hangs all larger neighbours of a node below the smallest node near it (large star), then all smaller ones
    (small star). Rounds are joins with one minimum per node, never a list of neighbours; their number grows with the
    logarithm of the number of nodes. It ends when a round changes nothing.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = work.write(ordered, f"{name}-0")
    before, step = None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, step = state, step + 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(nearest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        large = work.write(large, f"{name}-{step}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = work.write(small, f"{name}-{step}")
