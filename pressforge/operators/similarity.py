"""Embedding baselines (L1-L3): cosine similarity, distance to a group
centroid, and a threshold classifier shaped like a submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """L1."""
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def centroids(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Per-group mean vector: explode positions, average per (group, pos)
    (partial aggregation), reassemble in position order (dimension-bounded)."""
    e = df.select(key, F.posexplode(vec).alias("pos", "v"))
    m = e.groupBy(key, "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return m.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("centroid"))


def centroid_distance(df: DataFrame, key: str, vec: str) -> DataFrame:
    """L2: 1 - cosine between each vector and its group's centroid."""
    c = centroids(df, key, vec)
    return df.join(c, key).withColumn("distance", F.lit(1.0) - cosine(F.col(vec), F.col("centroid")))


def parts_distance(parts: DataFrame, image: str, foreground: Column, vec: str) -> DataFrame:
    """L2 per image: 1 - cosine between the mean vectors of its foreground and of its background parts,
    and how many of each. Images without one of them have no distance (null)."""
    p = parts.select(image, foreground.alias("_fg"), F.posexplode(vec).alias("pos", "v")).filter(F.col("_fg").isNotNull())
    v = F.col("v").cast("double")
    m = p.groupBy(image, "pos").agg(F.avg(F.when(F.col("_fg"), v)).alias("f"), F.avg(F.when(~F.col("_fg"), v)).alias("b"))
    s = m.groupBy(image).agg(F.sum(F.col("f") * F.col("b")).alias("fb"), F.sum(F.col("f") * F.col("f")).alias("ff"), F.sum(F.col("b") * F.col("b")).alias("bb"))
    n = parts.groupBy(image).agg(F.count_if(foreground).alias("n_foreground"), F.count_if(~foreground).alias("n_background"))
    norm = F.sqrt(F.col("ff") * F.col("bb"))
    return n.join(s, image, "left").select(image, "n_foreground", "n_background", F.when(norm > 0, F.lit(1.0) - F.col("fb") / norm).alias("distance"))


def threshold_classifier(sim: Column, t: float = 0.0) -> dict[str, Column]:
    """L3: similarity below ``t`` -> manipulated; confidence clipped to [0, 1]."""
    label = F.when(sim < F.lit(t), F.lit("manipulated")).otherwise(F.lit("authentic"))
    conf = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.lit(1.0) - sim) / F.lit(2.0)))
    mtype = F.when(sim < F.lit(t), F.lit("text_swap")).otherwise(F.lit("origin"))
    return {"label": label, "confidence": conf, "manipulation_type": mtype}
