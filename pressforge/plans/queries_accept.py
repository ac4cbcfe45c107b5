"""Registered query: the whole accept loop as one batch plan.

jobs -> face count gate (1-3 faces) -> best-face quality gate -> text gate (no
readable word is left after scrubbing) -> captions -> joint first-wins dedup (a
near image or the same caption as an earlier kept row) -> per-class quota ->
shot crop of the kept images' faces -> sample records with their remapped boxes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import draw, uniform
from ..operators import geometry as G
from ..operators.captions import with_captions
from ..operators.dedup import greedy_keep
from ..operators.neardup import near_pairs, neighbour_edges
from ..operators.quota import quota_fill
from ..session import cut_lineage, scratch_dir
from ..sources.sinks import image_path, make_records
from ..streaming import incremental as INC
from . import oracle as O
from . import sqlgen as Q
from .pipeline import goals_of, records_as_text
from .queries_core import GOAL_SQL
from .queries_dedup import V_HASH_SQL, greedy_sql, v_hash
from .queries_geo import _HITS_SQL, _QUALITY_SQL, GATED_SQL, center_rect_sql, remap_sql, union_rect_sql, _SHOT_EX, _IS_UNION
from .registry import register
from .views import (FACE_LINES, SEED, WORD_LINES, faces_of, in_span, job_parts, jobs_of, lines_with_word, table, v_face,
                    v_images, v_job, v_job_key, v_word, words_of)


def v_image_vector(spark, sf_dir):
    """id of every image and the fingerprint _h of its vector."""
    e = v_hash(spark, sf_dir).select("vec_id", F.col("h").alias("_h"))
    n = table(spark, sf_dir, "embeddings").count()  # one number
    i = v_images(spark, sf_dir).select(F.col("img").alias("id"), F.pmod(F.col("img"), F.lit(max(1, n))).alias("vec_id"))
    return i.join(e, "vec_id", "left").select("id", "_h")


def with_image_hash(df, seed=SEED):
    """h from id and _h: three in ten images are near copies (at most two bits off) of the others on
    the same vector."""
    near = F.element_at(F.array(*[F.lit(m).cast("bigint") for m in (0, 1, 3)]), (F.pmod(draw(seed, F.col("id"), "hash"), F.lit(3)) + 1).cast("int"))
    far = F.shiftleft(draw(seed, F.col("id"), "hash").cast("bigint"), 16)
    mask = F.when(uniform(seed, F.col("id"), "near") < 0.3, near).otherwise(far)
    return df.withColumn("h", F.col("_h").bitwiseXOR(mask)).drop("_h")


def v_image_hash(spark, sf_dir, seed=SEED):
    """A fingerprint per image (id, h), from the embeddings."""
    return with_image_hash(v_image_vector(spark, sf_dir), seed)


_HASH_SQL = (f"SELECT o_orderkey AS id, xor(h, CASE WHEN {Q.uniform(SEED, 'o_orderkey', 'near')} < 0.3 "
             f"THEN ([0, 1, 3])[{Q.draw(SEED, 'o_orderkey', 'hash')} % 3 + 1] ELSE cast({Q.draw(SEED, 'o_orderkey', 'hash')} AS BIGINT) << 16 END) AS h "
             f"FROM orders LEFT JOIN ({V_HASH_SQL}) v ON o_orderkey % (SELECT count(*) FROM embeddings) = vec_id")


def passing_images(images, faces, words):
    """img of the images that pass the gates, and their normalised faces: 1-3 faces, a good best
    face, and no readable word left after scrubbing (one on a protected face box stays)."""
    nf = G.normalize_boxes(faces)
    counted = G.face_count_gate(images, nf)
    gated = nf.join(counted.select("img"), "img", "left_semi")
    good = G.face_quality_gate(gated).filter(F.col("passes")).select("img")
    left = G.still_readable(images, words, G.union_crop(gated, expand=2.0))
    clean = left.filter(~F.col("still_readable")).select("img")
    return good.join(clean, "img", "left_semi"), gated


def with_crops(kept, gated, seed=SEED):
    """Sample records of the kept rows, with the crop of their shot and the faces mapped into it."""
    shots = kept.select(F.col("id").alias("img"), "shot")
    boxes = G.shot_crop(gated.join(shots.select("img"), "img", "left_semi"), shots)
    per_img = boxes.groupBy("img").agg(F.sort_array(F.collect_list(F.struct(
        "ix", "ix2", "ix3", F.array(*[F.col(c).cast("int") for c in ("bx1", "by1", "bx2", "by2")]).alias("b")))).alias("_bs"))
    per_img = per_img.select(F.col("img").alias("id"), F.transform("_bs", lambda s: s["b"]).alias("mtcnn_boxes"))
    return make_records(kept.join(per_img, "id", "left").withColumn("image", image_path(F.col("bucket"), F.col("id"), seed)))


CANDIDATE = ["id", "accept_order", "bucket", "text", "fake_text_pos", "fake_cls", "shot"]


def accept_batch(spark, sf_dir, seed=SEED, goals=None):
    passing, gated = passing_images(v_images(spark, sf_dir), v_face(spark, sf_dir), v_word(spark, sf_dir))
    job = v_job(spark, sf_dir, seed)
    jobs = job.join(passing.withColumnRenamed("img", "id"), "id", "left_semi")
    caps = with_captions(jobs, seed).select(*CANDIDATE)
    caps = cut_lineage(caps.join(v_image_hash(spark, sf_dir, seed), "id"))
    edges = neighbour_edges(near_pairs(caps))
    kept = greedy_keep(caps, "accept_order", [("h", edges), ("text", None)]).filter("kept").drop("kept", "h")
    kept = cut_lineage(quota_fill(kept, goals or goals_of(job)))
    return with_crops(kept, gated, seed)  # only what the quota keeps is cropped


def v_candidates(spark, sf_dir, span=None, seed=SEED):
    """What arrives at the accept loop (in a span of arrivals): a caption with the fingerprint of its
    image, and what the detectors found in it (faces, words), so that a batch needs nothing but its
    own rows. Order lines are dealt out like the jobs before detections are made of them: these take
    several times the bytes, and lie where they are joined."""
    parts = job_parts(in_span(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"), "o_orderkey", span))  # as v_job has
    li = in_span(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey", span)
    faces = _per_image(faces_of(li.select(*FACE_LINES).repartition(parts, "l_orderkey")), "faces")
    words = _per_image(words_of(lines_with_word(li.select(*WORD_LINES), spark, sf_dir).repartition(parts, "l_orderkey")), "words")
    hashes = with_image_hash(in_span(v_image_vector(spark, sf_dir), "id", span), seed)
    caps = with_captions(v_job(spark, sf_dir, seed, span=span), seed).select(*CANDIDATE).join(hashes, "id")
    return caps.join(faces, "id", "left").join(words, "id", "left")


def _per_image(found, name):
    """id of every image with detections, and their list."""
    rows = F.collect_list(F.struct(*[c for c in found.columns if c != "img"]))
    return found.groupBy(F.col("img").alias("id")).agg(rows.alias(name))


ROWS_A_CHUNK = 4_000_000  # arrivals: a micro-batch shuffles about 1 KB for each


def arrival_spans(spark, sf_dir, chunks):
    """The arrivals, which are order keys, as ``chunks`` ranges of equal width, or as many as keep
    chunks at ROWS_A_CHUNK rows on average."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lo, hi, n = o.agg(F.min("o_orderkey"), F.max("o_orderkey"), F.count(F.lit(1))).first()
    chunks = max(chunks, -(-n // ROWS_A_CHUNK))
    width = max(1, (int(hi) - int(lo)) // chunks + 1)
    return [(int(lo) + i * width, int(lo) + (i + 1) * width - 1) for i in range(chunks)]


def detections(df, name):
    """The faces or words of candidates as rows."""
    return df.select(F.col("id").alias("img"), F.inline(name))


CROPPED = ["ix", "ix2", "ix3", "prob", "x1", "y1", "x2", "y2"]  # of a face, what its crop needs


def gates(df):
    """The rows of a batch whose images pass, without their words and the landmarks of their faces."""
    passing, _ = passing_images(df.select(F.col("id").alias("img")), detections(df, "faces"), detections(df, "words"))
    rest = df.drop("words").withColumn("faces", F.transform("faces", lambda f: F.struct(*[f[c].alias(c) for c in CROPPED])))
    return rest.join(passing.withColumnRenamed("img", "id"), "id", "left_semi")


_GOOD = (f"SELECT img FROM ({GATED_SQL}) QUALIFY row_number() OVER (PARTITION BY img ORDER BY prob DESC, ix, ix2, ix3) = 1 "
         f"AND coalesce({_QUALITY_SQL}, false)")
_JOBS = f"SELECT * FROM ({O.v_job_sql()}) WHERE id IN ({_GOOD}) AND id NOT IN (SELECT img FROM ({_HITS_SQL}))"
_DEDUP = greedy_sql("*", f"bit_count(xor(a.h, b.h)) <= {V.PHASH_DISTANCE_MAX} OR a.text = b.text", 16,
                    f"SELECT * FROM ({O.captions_sql(_JOBS)}) JOIN ({_HASH_SQL}) USING (id)")
_KEPT = (f"SELECT * EXCLUDE (gb, goal) FROM ({_DEDUP}) "
         f"JOIN ({GOAL_SQL}) ON bucket = gb QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY accept_order) <= goal")
_FACES = f"SELECT * FROM ({GATED_SQL}) WHERE img IN (SELECT id FROM ({_KEPT}))"
_RECT = (f"SELECT img, " + ", ".join(f"CASE WHEN {_IS_UNION} THEN u{c} ELSE c{c} END AS {c}" for c in ("cx1", "cy1", "cx2", "cy2"))
         + f" FROM (SELECT g.img, k.shot, {union_rect_sql(_SHOT_EX, pre='u')}, {center_rect_sql(pre='c')} "
         f"FROM (SELECT img, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, avg((x1 + x2) / 2.0) AS mx, "
         f"avg((y1 + y2) / 2.0) AS my FROM ({_FACES}) GROUP BY img) g JOIN ({_KEPT}) k ON g.img = k.id)")
_BOXES = remap_sql(f"SELECT f.*, r.cx1, r.cy1, r.cx2, r.cy2 FROM ({_FACES}) f JOIN ({_RECT}) r ON f.img = r.img")
_PER_IMG = (f"SELECT img, string_agg(concat_ws(',', bx1, by1, bx2, by2), ';' ORDER BY ix, ix2, ix3) AS boxes "
            f"FROM ({_BOXES}) GROUP BY img")
ACCEPT_SQL = (f"SELECT k.id, {O.image_path_sql('k.bucket', 'k.id')} AS image, k.text, k.fake_cls, '' AS fake_image_box, "
              f"{Q.ints_to_str('k.fake_text_pos')} AS fake_text_pos, coalesce(b.boxes, '') AS mtcnn_boxes "
              f"FROM ({_KEPT}) k LEFT JOIN ({_PER_IMG}) b ON k.id = b.img")


@register("accept_batch", ACCEPT_SQL)
def q_accept_batch(spark, sf_dir):
    """The accept loop end to end as one batch plan (gates, captions, dedup,
    quota, crop boxes, records)."""
    return records_as_text(accept_batch(spark, sf_dir))


@register("stream_accept_gated", ACCEPT_SQL)
def q_stream_accept_gated(spark, sf_dir):
    """M1 whole: the accept loop as a stream with all gates (faces, text, near image, caption,
    quota); equals the batch plan."""
    work = scratch_dir(spark, "gated")
    arriving = (v_candidates(spark, sf_dir, span) for span in arrival_spans(spark, sf_dir, 4))
    with INC.settings(spark, INC.FREED):
        goals = goals_of(v_job(spark, sf_dir))
    INC.accept_arriving(spark, arriving, work, goals, gates=gates, hash_col="h")
    kept = INC.accepted(spark, work)
    return records_as_text(with_crops(kept.drop("faces"), G.normalize_boxes(detections(kept, "faces"))))


def accept_funnel(spark, sf_dir, seed=SEED):
    """id, reason for every candidate: the first gate of the accept loop that it fails, in the
    loop's order, with the loop's own gates; ``passed`` rows go on to the quota."""
    images, faces, words = v_images(spark, sf_dir), v_face(spark, sf_dir), v_word(spark, sf_dir)
    nf = G.normalize_boxes(faces)
    # each gate's rows are read twice below
    counted = cut_lineage(G.face_count_gate(images, nf).select(F.col("img").alias("id"), F.lit(True).alias("counted")))
    gated = cut_lineage(nf.join(counted.withColumnRenamed("id", "img"), "img", "left_semi"))
    good = cut_lineage(G.face_quality_gate(gated).filter("passes").select(F.col("img").alias("id"), F.lit(True).alias("good")))
    reached = good.select(F.col("id").alias("img"))  # the words of other images decide nothing
    i, w, f = (x.join(reached, "img", "left_semi") for x in (images, words, gated))
    left = G.still_readable(i, w, G.union_crop(f, expand=2.0)).filter("still_readable").select(F.col("img").alias("id"), F.lit(True).alias("readable"))
    d = v_job_key(spark, sf_dir).join(counted, "id", "left").join(good, "id", "left").join(left, "id", "left")
    early = F.when(F.col("counted").isNull(), "face_count").when(F.col("good").isNull(), "face_quality").when(F.col("readable").isNotNull(), "residual_text")
    d = cut_lineage(d.withColumn("reason", early).drop("counted", "good", "readable").join(v_image_vector(spark, sf_dir), "id"))
    # as in the loop, captions are made of what passes these gates
    clean = with_captions(jobs_of(d.filter("reason is null"), seed), seed).select("id", "accept_order", "text", "_h")
    clean = cut_lineage(with_image_hash(clean, seed))
    edges = cut_lineage(neighbour_edges(near_pairs(clean)))
    judged = cut_lineage(greedy_keep(clean, "accept_order", [("h", edges), ("text", None)]).select("id", "accept_order", "h", "kept"))
    first = judged.filter("kept").groupBy("h").agg(F.min("accept_order").alias("first"))
    near = first.unionByName(edges.join(first.withColumnRenamed("h", "b"), "b").select(F.col("a").alias("h"), "first")).groupBy("h").agg(F.min("first").alias("first"))
    late = judged.join(near, "h", "left").select("id", F.when(F.col("kept"), "passed").when(F.col("first") < F.col("accept_order"), "near_image").otherwise("same_caption").alias("reason"))
    return d.filter("reason is not null").select("id", "reason").unionByName(late)


_CAPTIONED = f"SELECT * FROM ({O.captions_sql(O.v_job_sql())}) JOIN ({_HASH_SQL}) USING (id)"
_EARLY = (f"SELECT id, accept_order, text, h, CASE WHEN id NOT IN (SELECT img FROM ({GATED_SQL})) THEN 'face_count' WHEN id NOT IN ({_GOOD}) THEN 'face_quality' "
          f"WHEN id IN (SELECT img FROM ({_HITS_SQL})) THEN 'residual_text' END AS reason FROM ({_CAPTIONED})")
_FUNNEL_DEDUP = greedy_sql("*", f"bit_count(xor(a.h, b.h)) <= {V.PHASH_DISTANCE_MAX} OR a.text = b.text", 16, "SELECT * EXCLUDE (reason) FROM early WHERE reason IS NULL")


@register("accept_funnel",
          f"WITH early AS MATERIALIZED ({_EARLY}), kept AS MATERIALIZED ({_FUNNEL_DEDUP}) "
          f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN reason IS NOT NULL THEN reason WHEN id IN (SELECT id FROM kept) THEN 'passed' "
          f"WHEN EXISTS (SELECT 1 FROM kept k WHERE k.accept_order < e.accept_order AND bit_count(xor(k.h, e.h)) <= {V.PHASH_DISTANCE_MAX}) THEN 'near_image' "
          f"ELSE 'same_caption' END AS reason FROM early e) GROUP BY reason")
def q_accept_funnel(spark, sf_dir):
    """Candidates by the first gate of the accept loop that they fail, near images included."""
    return accept_funnel(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
