"""Registered queries: remaining inventory items."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as T
from ..operators import captions as CAP
from ..operators import geometry as G
from ..operators.dedup import first_wins
from ..session import cut_lineage, scratch_dir
from ..sources import readers as RD
from ..sources import sinks as SK
from . import oracle as O
from . import sqlgen as Q
from .pipeline import all_records, records_as_text
from .queries_core import ALL_RECORDS_SQL
from .queries_eval import EV_SQL, v_eval
from .queries_geo import GATED_SQL, NF_SQL, READABLE_SQL, TARGET, _QUALITY_SQL, _SIZE_SQL
from .queries_quota import _FILL_SQL, JOBS_SQL, _jobs_status, _remainders
from .registry import register
from .views import SEED, table, v_face, v_images, v_job, v_word


_TS_SRC = "SELECT * EXCLUDE (bucket), 'irr' AS bucket FROM (" + O.v_job_sql() + ")"


@register("ts_span",
          f"SELECT id, {Q.ints_to_str('fake_text_pos')} AS span, {Q.token_count('text')} AS n_tokens "
          f"FROM ({O.captions_sql(_TS_SRC)})")
def q_ts_span(spark, sf_dir):
    """A text swap marks every token."""
    c = CAP.with_captions(v_job(spark, sf_dir).withColumn("bucket", F.lit("irr")), SEED)
    return c.select("id", T.ints_to_str("fake_text_pos").alias("span"), T.token_count(F.col("text")).alias("n_tokens"))


@register("scan_jsonl", f"SELECT * FROM ({ALL_RECORDS_SQL})")
def q_scan_jsonl(spark, sf_dir):
    """A5: JSON Lines with blank lines in between, read FAILFAST (blank lines
    are skipped; a malformed line would fail the read)."""
    path = os.path.join(scratch_dir(spark, "jsonl-blank"), "metadata.jsonl")
    rec = cut_lineage(all_records(spark, sf_dir))  # read for the lines and for the blank ones
    lines = rec.select(F.to_json(F.struct(*rec.columns)).alias("value"))
    lines.unionByName(rec.select(F.lit("").alias("value"))).write.text(path)
    return records_as_text(RD.read_jsonl(spark, path))


@register("scan_snapshot", f"SELECT * FROM ({ALL_RECORDS_SQL})")
def q_scan_snapshot(spark, sf_dir):
    """A6 + A7: no JSONL log exists, so the snapshot is read."""
    base = scratch_dir(spark, "meta")
    snap = SK.write_snapshot(all_records(spark, sf_dir), os.path.join(base, "snapshot"))
    return records_as_text(RD.read_metadata(spark, os.path.join(base, "metadata.jsonl"), snap))


@register("submission_write",
          f"SELECT cast(id AS VARCHAR) AS id, pred_label AS label, cast(len(pred_tokens) AS BIGINT) AS n_tokens FROM ({EV_SQL})")
def q_submission_write(spark, sf_dir):
    """Classification.csv and the grounding file written, read back and
    joined on id."""
    d = scratch_dir(spark, "sub")
    sub = v_eval(spark, sf_dir).select(F.col("id").cast("string").alias("id"), F.col("pred_label").alias("label"),
                                       "confidence", F.col("pred_type").alias("manipulation_type"),
                                       F.col("pred_tokens").alias("tokens"))
    SK.write_classification(sub, os.path.join(d, "classification.csv"))
    SK.grounding_lines(sub).write.text(os.path.join(d, "text_grounding.jsonl"))
    cls = RD.read_classification(spark, os.path.join(d, "classification.csv"))
    grd = RD.read_grounding_lines(spark, os.path.join(d, "text_grounding.jsonl"))
    n = grd.groupBy("id").agg(F.count("token").alias("n_tokens"))
    return cls.join(n, "id", "full").select("id", "label", "n_tokens")


@register("resolution_qc",
          f"SELECT img, cw, ch, cw >= {V.POST_W} AND ch >= {V.POST_H} AS ok FROM (SELECT img, "
          f"CASE WHEN iw / ih > {TARGET!r} THEN cast(round_even(ih * {TARGET!r}, 0) AS BIGINT) ELSE iw END AS cw, "
          f"CASE WHEN iw / ih > {TARGET!r} THEN ih ELSE cast(round_even(iw / {TARGET!r}, 0) AS BIGINT) END AS ch FROM ({_SIZE_SQL}))")
def q_resolution_qc(spark, sf_dir):
    """The centred ratio crop must hold at least 400 x 256 pixels (no
    upscaling to the release size)."""
    o = table(spark, sf_dir, "orders")
    s = o.select(F.col("o_orderkey").alias("img"), (F.lit(512) + F.col("o_custkey") * 7 % 1024).alias("iw"),
                 (F.lit(512) + F.col("o_orderkey") * 11 % 1024).alias("ih"))
    r = G.central_crop(F.col("iw"), F.col("ih"))
    c = s.select("img", (r["cx2"] - r["cx1"]).alias("cw"), (r["cy2"] - r["cy1"]).alias("ch"))
    return c.withColumn("ok", (F.col("cw") >= V.POST_W) & (F.col("ch") >= V.POST_H))


@register("composition",
          f"WITH u AS (SELECT bucket, is_old FROM ({JOBS_SQL}) WHERE is_old UNION ALL SELECT bucket, false FROM ({_FILL_SQL})), "
          f"c AS (SELECT bucket, count(*) AS n, sum(CASE WHEN is_old THEN 1 ELSE 0 END) AS base FROM u GROUP BY bucket) "
          f"SELECT bucket, n, round(n / sum(n) OVER (), 6) AS share, "
          f"round(CASE WHEN base > 0 THEN 100.0 * (n - base) / base END, 6) AS expansion_pct FROM c")
def q_composition(spark, sf_dir):
    """Per class, count, share of the whole and expansion over the
    stored base (%). The share window runs over one row per class."""
    from ..operators.quota import quota_fill
    j = _jobs_status(spark, sf_dir)
    old = j.filter("is_old").select("bucket", "is_old")
    new = quota_fill(j.filter(~F.col("is_old")).select("id", "bucket", "accept_order"), _remainders(spark, sf_dir))
    u = old.unionByName(new.select("bucket", F.lit(False).alias("is_old")))
    c = u.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_old").cast("bigint")).alias("base"))
    return c.select("bucket", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"),
                    F.round(F.when(F.col("base") > 0, F.lit(100.0) * (F.col("n") - F.col("base")) / F.col("base")), 6)
                    .alias("expansion_pct"))


_FUNNEL_SQL = f"""
WITH nf AS ({NF_SQL}),
cnt AS (SELECT img, count(*) AS n FROM nf GROUP BY img),
best AS (SELECT img, coalesce({_QUALITY_SQL}, false) AS q FROM ({GATED_SQL})
         QUALIFY row_number() OVER (PARTITION BY img ORDER BY prob DESC, ix, ix2, ix3) = 1),
txt AS (SELECT DISTINCT img FROM ({READABLE_SQL})),
cap AS (SELECT id, accept_order, text FROM ({O.captions_sql(O.v_job_sql())})),
first AS (SELECT id FROM cap QUALIFY row_number() OVER (PARTITION BY text ORDER BY accept_order) = 1)
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN coalesce(cnt.n, 0) NOT BETWEEN {V.MIN_FACES} AND {V.MAX_FACES} THEN 'face_count'
              WHEN NOT best.q THEN 'face_quality'
              WHEN txt.img IS NOT NULL THEN 'residual_text'
              WHEN first.id IS NULL THEN 'same_caption'
              ELSE 'passed' END AS reason
  FROM cap LEFT JOIN cnt ON cap.id = cnt.img LEFT JOIN best ON cap.id = best.img
  LEFT JOIN txt ON cap.id = txt.img LEFT JOIN first ON cap.id = first.id)
GROUP BY reason
"""


@register("quality_funnel", _FUNNEL_SQL)
def q_quality_funnel(spark, sf_dir):
    """The first gate each candidate fails (face count, face quality,
    readable text, repeated caption), counted per reason. Every gate is a
    per-image aggregate joined back once."""
    nf = G.normalize_boxes(v_face(spark, sf_dir))
    cnt = G.face_counts(v_images(spark, sf_dir), nf).withColumnRenamed("img", "id")
    gated = nf.join(G.face_count_gate(v_images(spark, sf_dir), nf).select("img"), "img", "left_semi")
    best = G.face_quality_gate(gated).select(F.col("img").alias("id"), F.coalesce("passes", F.lit(False)).alias("q"))
    txt = G.readable_words(v_word(spark, sf_dir)).select(F.col("img").alias("id")).distinct().withColumn("t", F.lit(True))
    cap = CAP.with_captions(v_job(spark, sf_dir), SEED).select("id", "accept_order", "text")
    first = first_wins(cap, ["text"]).select("id").withColumn("f", F.lit(True))
    j = cap.join(cnt, "id", "left").join(best, "id", "left").join(txt, "id", "left").join(first, "id", "left")
    reason = (F.when(~F.coalesce(F.col("n_faces"), F.lit(0)).between(V.MIN_FACES, V.MAX_FACES), F.lit("face_count"))
              .when(~F.col("q"), F.lit("face_quality"))
              .when(F.col("t").isNotNull(), F.lit("residual_text"))
              .when(F.col("f").isNull(), F.lit("same_caption"))
              .otherwise(F.lit("passed")))
    return j.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_FIRST_1000 = ("SELECT name, min(pos) AS first_pos FROM (SELECT trim(c_name) AS name, row_number() OVER (ORDER BY c_custkey) AS pos "
               "FROM customer QUALIFY pos <= 1000) GROUP BY name")


@register("limit_then_distinct", _FIRST_1000)
def q_limit_then_distinct(spark, sf_dir):
    """The first 1,000 names in file order are taken before the distinct
    (the cap is the feature: the gazetteer's max_items)."""
    path = os.path.join(scratch_dir(spark, "tsv1000"), "cities.txt")
    c = table(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    c.select(F.concat_ws("\t", F.col("c_custkey").cast("string"), F.col("c_name")).alias("value")).write.text(path)
    return RD.city_names_tsv(spark, path, max_items=1000)


@register("ordered_distinct",
          "SELECT md5(text) AS text_md5, min(doc_id) AS first_id FROM documents GROUP BY text")
def q_ordered_distinct(spark, sf_dir):
    """Distinct texts with the position of their first occurrence."""
    d = table(spark, sf_dir, "documents")
    return d.groupBy("text").agg(F.min("doc_id").alias("first_id")).select(F.md5("text").alias("text_md5"), "first_id")
