"""Registered queries: scene pool draw (E11), submission files (A9-A11, B7),
explanation checks (P4), versioned release (P6) and file listing (A4)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import draw, uniform
from ..functions.text import token_count, tokens
from ..operators import clusters as CL
from ..operators import evaluate as EV
from ..operators import scenes as SC
from ..plans.ranking import DENSE_BITS, ordered_rank
from ..session import scratch_dir
from ..sources import readers as RD
from ..sources import sinks as SK
from . import sqlgen as Q
from .queries_dedup import CLUSTERS_SQL, V_HASH_DUP_SQL, v_hash_dup
from .queries_eval import EV_SQL, v_eval
from .queries_quota import _NEW_SQL, _REM_SQL, _jobs_status, _remainders
from .queries_scene import _DEDUP_SQL
from .registry import register
from .views import SEED, v_job


def _pool_sizes(total: int) -> tuple[int, int]:
    mult = V.POOL_MULT_BIG if total >= V.POOL_BIG_AT else V.POOL_MULT_SMALL
    return max(V.POOL_MIN, int(total * mult)), max(V.BACKUP_MIN, int(total * V.BACKUP_FRAC))


_PSHUF = Q.draw(SEED, "id", "poolshuf")
_POOL_DRAW_SQL = f"""
WITH rem AS (SELECT sum(remainder) AS total FROM ({_REM_SQL})),
sz AS (SELECT greatest({V.POOL_MIN}, cast(trunc(total * CASE WHEN total >= {V.POOL_BIG_AT} THEN {V.POOL_MULT_BIG} ELSE {V.POOL_MULT_SMALL} END) AS BIGINT)) AS n,
              greatest({V.BACKUP_MIN}, cast(trunc(total * {V.BACKUP_FRAC}) AS BIGINT)) AS b FROM rem),
pool AS (SELECT id AS scene_id, row_number() OVER (ORDER BY d, id) AS pos FROM (
           SELECT id, {_PSHUF} AS d FROM (
             SELECT id, row_number() OVER (ORDER BY id) AS rk FROM ({_DEDUP_SQL})) WHERE rk <= (SELECT n FROM sz))),
jobs AS (SELECT id, row_number() OVER (ORDER BY accept_order) AS i FROM ({_NEW_SQL}))
SELECT j.id, p.scene_id FROM jobs j, sz JOIN pool p ON p.pos = CASE WHEN j.i <= least(sz.n, (SELECT count(*) FROM pool))
  THEN (SELECT count(*) FROM pool) - j.i + 1 ELSE 1 + {Q.draw(SEED, 'j.id', 'backup')} % least(sz.b, (SELECT count(*) FROM pool)) END
"""


@register("pool_draw", _POOL_DRAW_SQL)
def q_pool_draw(spark, sf_dir):
    """New jobs take scenes from the end of the shuffled pool without
    replacement; once it is empty, a seeded draw from the backup slice (the
    first positions) with replacement. Pool size from E10 on the remainder."""
    total = sum(_remainders(spark, sf_dir).values())
    n, b = _pool_sizes(total)
    pool = SC.scene_pool(v_job(spark, sf_dir), n, SEED, partial=True).select(F.col("id").alias("scene_id"))
    pool = pool.withColumn("_k", draw(SEED, F.col("scene_id"), "poolshuf"))
    pool = ordered_rank(pool, "_k", None, out="pos", bits=12, tiebreak=["scene_id"]).select("scene_id", "pos")
    size = pool.count()  # one number: the pool may be smaller than asked
    jobs = _jobs_status(spark, sf_dir).filter(~F.col("is_old")).select("id", "accept_order")
    jobs = ordered_rank(jobs, "accept_order", None, out="i", bits=DENSE_BITS)
    target = F.when(F.col("i") <= F.lit(min(n, size)), F.lit(size) - F.col("i") + 1).otherwise(
        F.lit(1) + F.pmod(draw(SEED, F.col("id"), "backup"), F.lit(min(b, size))))
    return jobs.withColumn("pos", target).join(pool, "pos").select("id", "scene_id")


def _submission(spark, sf_dir):
    return v_eval(spark, sf_dir).select(F.col("id").cast("string").alias("id"), F.col("pred_label").alias("label"),
                                        "confidence", F.col("pred_type").alias("manipulation_type"),
                                        F.col("pred_tokens").alias("tokens"), "n_tok")


@register("scan_submission",
          f"SELECT cast(id AS VARCHAR) AS id, pred_label AS label, round(confidence, 6) AS confidence, pred_type AS manipulation_type FROM ({EV_SQL})")
def q_scan_submission(spark, sf_dir):
    """B7 + A9: classification.csv written with a header, read back with a fixed schema."""
    path = os.path.join(scratch_dir(spark, "cls"), "classification.csv")
    SK.write_classification(_submission(spark, sf_dir), path)
    d = RD.read_classification(spark, path)
    return d.select("id", "label", F.round("confidence", 6).alias("confidence"), "manipulation_type")


@register("scan_grounding",
          f"SELECT cast(id AS VARCHAR) AS id, cast(unnest(CASE WHEN len(pred_tokens) = 0 THEN [NULL] ELSE pred_tokens END) AS INTEGER) AS token FROM ({EV_SQL})")
def q_scan_grounding(spark, sf_dir):
    """B7 + A10: id -> token list as one JSON object per line, read back
    exploded (an empty list keeps one row with a NULL token)."""
    path = os.path.join(scratch_dir(spark, "grd"), "text_grounding.jsonl")
    SK.grounding_lines(_submission(spark, sf_dir)).write.text(path)
    return RD.read_grounding_lines(spark, path).select("id", F.col("token").cast("int").alias("token"))


def _explanations(spark, sf_dir):
    s = _submission(spark, sf_dir).filter(F.col("label") == EV.POS)
    u1, u2 = uniform(SEED, F.col("id"), "rx"), uniform(SEED, F.col("id"), "ry")
    extra = F.when(uniform(SEED, F.col("id"), "xtok") < 0.1, F.array(F.col("n_tok") + 5)).otherwise(F.array().cast("array<int>"))
    region = F.array(F.array(u1, u2, u1 + F.lit(0.3), u2 + F.lit(0.3)))
    return s.select("id", F.concat(F.slice("tokens", 1, 3), extra).alias("e_tokens"), region.alias("regions"), "tokens")


@register("scan_explanations",
          f"SELECT cast(id AS VARCHAR) AS id, len(pred_tokens[1:3]) + CASE WHEN {Q.uniform(SEED, 'cast(id AS VARCHAR)', 'xtok')} < 0.1 THEN 1 ELSE 0 END AS n_tokens, "
          f"1 AS n_regions FROM ({EV_SQL}) WHERE pred_label = 'manipulated'")
def q_scan_explanations(spark, sf_dir):
    """Optional explanation file (id -> tokens + normalised regions), one
    object per line, read back."""
    path = os.path.join(scratch_dir(spark, "expl"), "explanations.jsonl")
    e = _explanations(spark, sf_dir)
    e.select(F.to_json(F.create_map("id", F.struct(F.col("e_tokens").alias("tokens"), "regions"))).alias("v")).write.text(path)
    return RD.read_explanations(spark, path).select("id", F.size("tokens").alias("n_tokens"), F.size("regions").alias("n_regions"))


@register("explanation_violations",
          f"SELECT id, 'region_range' AS violation FROM (SELECT cast(id AS VARCHAR) AS id, {Q.uniform(SEED, 'cast(id AS VARCHAR)', 'rx')} AS x1, "
          f"{Q.uniform(SEED, 'cast(id AS VARCHAR)', 'ry')} AS y1 FROM ({EV_SQL}) WHERE pred_label = 'manipulated') WHERE x1 + 0.3 > 1 OR y1 + 0.3 > 1 "
          f"UNION ALL SELECT cast(id AS VARCHAR), 'token_not_predicted' FROM ({EV_SQL}) "
          f"WHERE pred_label = 'manipulated' AND {Q.uniform(SEED, 'cast(id AS VARCHAR)', 'xtok')} < 0.1")
def q_explanation_violations(spark, sf_dir):
    """Regions inside [0,1] with x1<x2, y1<y2; explanation tokens must be
    predicted tokens. One row per (id, violated rule)."""
    e = _explanations(spark, sf_dir)
    bad_region = F.exists("regions", lambda r: (F.size(r) != 4) | F.exists(r, lambda v: (v < 0) | (v > 1)) |
                          (r[0] >= r[2]) | (r[1] >= r[3]))
    bad_tok = F.exists("e_tokens", lambda t: ~F.array_contains(F.col("tokens"), t))
    rules = F.array_compact(F.array(F.when(bad_region, F.lit("region_range")), F.when(bad_tok, F.lit("token_not_predicted"))))
    return e.select("id", F.explode(rules).alias("violation"))


@register("release_read",
          f"SELECT doc_id AS id, 'v1' AS version FROM (SELECT doc_id, {Q.uniform(SEED, 'md5(text)', 'split')} AS u FROM documents) WHERE u < 0.8")
def q_release_read(spark, sf_dir):
    """The sample table written partitioned by (version, split) and read
    back for version v1 / train (partition pruning)."""
    from ..plans.views import table
    d = table(spark, sf_dir, "documents")
    rel = d.select(F.col("doc_id").alias("id"), F.md5("text").alias("text_md5"),
                   EV.split_assign(None, F.md5("text"), SEED).alias("split"), F.lit("v1").alias("version"))
    path = os.path.join(scratch_dir(spark, "release"), "release")
    rel.write.partitionBy("version", "split").parquet(path)
    back = spark.read.parquet(path).filter((F.col("version") == "v1") & (F.col("split") == "train"))
    return back.select("id", "version")


_REL_SQL = (f"SELECT d.id, c.cluster, md5(d.text) AS text_md5, {Q.token_count('d.text')} AS n_tokens, "
            f"CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split FROM "
            f"(SELECT *, {Q.uniform(SEED, 'cluster', 'split')} AS u FROM ({CLUSTERS_SQL})) c JOIN ({V_HASH_DUP_SQL}) d ON d.h = c.h")


@register("release_samples", f"SELECT id, split, text_md5, n_tokens, n_tokens AS n_read FROM ({_REL_SQL}) WHERE split <> 'train'")
def q_release_samples(spark, sf_dir):
    """P6 + P1: the release as the docs have it: whole captions with their tokens, split by clusters
    of near images, written by (version, split); the held-out splits of the latest version are read
    back (an older version lies beside it)."""
    d = v_hash_dup(spark, sf_dir)
    rel = CL.split_near(d.select("id", "h", "text"), SEED).select("id", "split", "text", tokens(F.col("text")).alias("tokens"), token_count(F.col("text")).alias("n_tokens"))
    path = os.path.join(scratch_dir(spark, "release"), "samples")
    old = rel.withColumn("version", F.lit("v1")).filter("split = 'train'")
    old.unionByName(rel.withColumn("version", F.lit("v2"))).write.partitionBy("version", "split").parquet(path)
    latest = spark.read.parquet(path).agg(F.max("version")).first()[0]  # from the folder names
    back = spark.read.parquet(path).filter((F.col("version") == latest) & (F.col("split") != "train"))
    return back.select("id", "split", F.md5("text").alias("text_md5"), "n_tokens", F.size("tokens").cast("bigint").alias("n_read"))
