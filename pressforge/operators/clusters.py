"""Duplicate clusters: connected components of an edge table, by contraction.

Each phase lets every vertex hook onto its smallest neighbour (if that is smaller than
itself), flattens the trees that result by pointer jumping, and replaces the edges by those
between tree roots. Edges inside a tree vanish, so later phases work on ever fewer edges;
vertices of finished clusters drop out. Everything is joins and aggregations keyed by
vertex; nothing is collected but a count a step.

A vertex with very many neighbours (the centre of a star) is only ever aggregated
(``min`` over its neighbours, partially in each task), and joins on a vertex are between
its edges and its one row of parents, which adaptive execution splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .evaluate import split_assign
from .neardup import near_pairs


def _flat(parent: DataFrame, max_steps: int) -> DataFrame:
    """v, p with every p a root: p(v) <- p(p(v)) until nothing changes; depth halves each time."""
    for _ in range(max_steps):
        up = parent.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
        new = cut_lineage(parent.join(up, parent["p"] == up["_v"]).select("v", F.col("_p").alias("p"), (F.col("_p") != F.col("p")).alias("moved")))
        parent = new.drop("moved")
        if not new.filter("moved").limit(1).count():
            return parent
    raise RuntimeError(f"trees not flat after {max_steps} steps")


def components(edges: DataFrame, max_phases: int = 64) -> DataFrame:
    """edges (a, b) -> node, cluster: the smallest node of its component, for every node on an
    edge between two different ones. Null ends are no edges."""
    e = edges.filter("a != b").select("a", "b")
    e = cut_lineage(e.union(e.select("b", "a")).distinct().toDF("u", "w"))
    label = None  # node, cluster of the nodes so far
    for _ in range(max_phases):
        if not e.limit(1).count():
            kind = e.schema["u"].dataType
            return label if label is not None else e.select(F.col("u").alias("node"), F.col("w").cast(kind).alias("cluster"))
        hook = e.groupBy("u").agg(F.least(F.min("w"), F.first("u")).alias("p")).withColumnRenamed("u", "v")
        flat = _flat(cut_lineage(hook), max_phases)
        if label is None:
            label = flat.toDF("node", "cluster")
        else:  # clusters that have no edge any more are finished and keep their label
            label = label.join(flat, label["cluster"] == flat["v"], "left").select("node", F.coalesce("p", "cluster").alias("cluster"))
        label = cut_lineage(label)
        e = e.join(flat.toDF("u", "_pu"), "u").join(flat.toDF("w", "_pw"), "w").filter("_pu != _pw").select("_pu", "_pw").distinct()
        e = cut_lineage(e.toDF("u", "w"))
    raise RuntimeError(f"clusters not settled after {max_phases} phases")


def near_clusters(df: DataFrame, col: str = "h") -> DataFrame:
    """h, cluster: for every distinct hash, the smallest hash it is linked to through near hashes."""
    found = components(near_pairs(df, col=col).select(F.col("ha").alias("a"), F.col("hb").alias("b")))
    values = df.select(F.col(col).alias("h")).filter("h is not null").distinct()
    return values.join(found.withColumnRenamed("node", "h"), "h", "left").select("h", F.coalesce("cluster", "h").alias("cluster"))


def split_near(df: DataFrame, seed, col: str = "h", key: Column | None = None, cuts=(0.8, 0.9)) -> DataFrame:
    """The columns of ``df``, its cluster and a split that no pair of near images straddles.
    Rows without a hash are split by ``key`` (the hash itself, so together, if not given)."""
    c = near_clusters(df, col).withColumnRenamed("h", col)
    d = df.join(c, col, "left").select(*df.columns, "cluster")
    group = F.coalesce(F.col("cluster").cast("string"), key.cast("string") if key is not None else F.lit(""))
    return d.withColumn("split", split_assign(d, group, seed, cuts))
