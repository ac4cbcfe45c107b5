"""Connected components of a link table, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressforge.session import cut_lineage


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """links: a, b (longs). node, component (its smallest node) for every linked node.

    Alternates the large-star and small-star steps: each node points its larger
    neighbours, then its smaller ones and itself, at the smallest neighbour, until
    every node hangs on its component's smallest. Groups are only aggregated, never
    gathered. ``rounds`` is a guard: the number needed grows with the logarithm of
    a component's size, and an unfinished result raises an error.
    """
    def least(edges: DataFrame) -> DataFrame:  # edges: u, v
        return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))

    def joined(edges: DataFrame) -> DataFrame:
        return edges.join(least(edges), F.col("u") == F.col("w"))

    now = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    for _ in range(rounds):
        both = now.union(now.select("v", "u").toDF("u", "v"))
        large = joined(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = joined(large)
        small = down.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).distinct()
        now = cut_lineage(small)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = state
    raise RuntimeError(f"components not settled after {rounds} rounds")
