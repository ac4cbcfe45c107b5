"""Registered queries: embedding baselines (L1-L3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import similarity as S, topk
from .registry import register
from .views import table

_DOT = "list_reduce(list_transform(range(1, len({a}) + 1), lambda i: cast({a}[i] AS DOUBLE) * cast({b}[i] AS DOUBLE)), lambda s, v: s + v, 0.0)"


def _cos_sql(a, b):
    return f"({_DOT.format(a=a, b=b)} / sqrt({_DOT.format(a=a, b=a)} * {_DOT.format(a=b, b=b)}))"


_PAIRS_SQL = ("SELECT i.vec_id // 2 AS pair_id, i.embedding AS img, t.embedding AS txt FROM embeddings i "
              "JOIN embeddings t ON t.vec_id = i.vec_id + 1 WHERE i.vec_id % 2 = 0")


def _pairs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    i = e.filter(F.col("vec_id") % 2 == 0).select((F.col("vec_id") / 2).cast("bigint").alias("pair_id"), F.col("embedding").alias("img"))
    t = e.filter(F.col("vec_id") % 2 == 1).select(((F.col("vec_id") - 1) / 2).cast("bigint").alias("pair_id"), F.col("embedding").alias("txt"))
    return i.join(t, "pair_id")


@register("cosine_similarity", f"SELECT pair_id, round({_cos_sql('img', 'txt')}, 6) AS cos FROM ({_PAIRS_SQL})")
def q_cosine_similarity(spark, sf_dir):
    """L1: image vector (even id) vs caption vector (next odd id)."""
    return _pairs(spark, sf_dir).select("pair_id", F.round(S.cosine(F.col("img"), F.col("txt")), 6).alias("cos"))


@register("fg_bg_distance",
          "WITH e AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings), "
          "c AS (SELECT label, list(m ORDER BY pos) AS centroid FROM (SELECT label, pos, avg(cast(v AS DOUBLE)) AS m FROM e GROUP BY label, pos) GROUP BY label) "
          f"SELECT vec_id, round(1.0 - {_cos_sql('embedding', 'centroid')}, 6) AS distance FROM embeddings JOIN c USING (label)")
def q_fg_bg_distance(spark, sf_dir):
    """L2: each vector against its label centroid."""
    e = table(spark, sf_dir, "embeddings")
    return S.centroid_distance(e, "label", "embedding").select("vec_id", F.round("distance", 6).alias("distance"))


@register("similarity_classifier",
          f"SELECT pair_id AS id, CASE WHEN c < 0.0 THEN 'manipulated' ELSE 'authentic' END AS label, "
          f"round(least(1.0, greatest(0.0, (1.0 - c) / 2.0)), 6) AS confidence, "
          f"CASE WHEN c < 0.0 THEN 'text_swap' ELSE 'origin' END AS manipulation_type "
          f"FROM (SELECT pair_id, {_cos_sql('img', 'txt')} AS c FROM ({_PAIRS_SQL}))")
def q_similarity_classifier(spark, sf_dir):
    """L3: threshold on cosine -> classification submission rows."""
    p = _pairs(spark, sf_dir).withColumn("c", S.cosine(F.col("img"), F.col("txt")))
    r = S.threshold_classifier(F.col("c"))
    return p.select(F.col("pair_id").alias("id"), r["label"].alias("label"), F.round(r["confidence"], 6).alias("confidence"),
                    r["manipulation_type"].alias("manipulation_type"))


@register("background_topk",
          "SELECT query, cast(rank AS INTEGER) AS rank, neighbour, round(s, 6) AS score FROM (SELECT query, neighbour, s, "
          "row_number() OVER (PARTITION BY query ORDER BY s DESC, neighbour) AS rank FROM (SELECT q.vec_id AS query, e.vec_id AS neighbour, "
          f"round({_cos_sql('q.embedding', 'e.embedding')}, 9) AS s FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0)) WHERE rank <= 10")
def q_background_topk(spark, sf_dir):
    """The ten nearest backgrounds of every twentieth vector, among all vectors, exactly."""
    e = table(spark, sf_dir, "embeddings")
    found = topk.background_topk(e, e.filter(F.col("vec_id") % 20 == 0))
    return found.withColumn("score", F.round("score", 6))


_PARTS = "SELECT vec_id // 6 AS img, (vec_id * 7 + label) % 5 < 2 AS fg, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings"


@register("fg_bg_parts",
          f"WITH m AS (SELECT img, pos, avg(cast(v AS DOUBLE)) FILTER (WHERE fg) AS f, avg(cast(v AS DOUBLE)) FILTER (WHERE NOT fg) AS b FROM ({_PARTS}) GROUP BY img, pos), "
          "s AS (SELECT img, sum(f * b) AS fb, sum(f * f) AS ff, sum(b * b) AS bb FROM m GROUP BY img) "
          "SELECT n.img, n_foreground, n_background, round(CASE WHEN sqrt(ff * bb) > 0 THEN 1.0 - fb / sqrt(ff * bb) END, 6) AS distance FROM "
          "(SELECT vec_id // 6 AS img, count(*) FILTER (WHERE (vec_id * 7 + label) % 5 < 2) AS n_foreground, count(*) FILTER (WHERE (vec_id * 7 + label) % 5 >= 2) AS n_background "
          "FROM embeddings GROUP BY 1) n LEFT JOIN s ON n.img = s.img")
def q_fg_bg_parts(spark, sf_dir):
    """L2: foreground against background of one image: six part vectors an image, some of them foreground."""
    e = table(spark, sf_dir, "embeddings").withColumn("img", F.expr("vec_id div 6"))
    d = S.parts_distance(e, "img", F.pmod(F.col("vec_id") * 7 + F.col("label"), F.lit(5)) < 2, "embedding")
    return d.withColumn("distance", F.round("distance", 6))
