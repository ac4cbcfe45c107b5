"""Registered queries: sampling, tagging and scene planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import choice_from, draw, uniform
from ..operators import scenes as SC
from ..operators import tags as TG
from ..plans.ranking import ordered_rank
from . import oracle as O
from . import sqlgen as Q
from .registry import register
from .views import SEED, table, v_job

POOL_SHARE = 2  # the pool is one scene for so many jobs
JOB = O.v_job_sql()


def _tags_str(c):
    return F.array_join(c, ",")


@register("uniform_choice", f"SELECT id, bucket, role, event FROM ({JOB})")
def q_uniform_choice(spark, sf_dir):
    """Uniform picks from fixed lists, per job."""
    return v_job(spark, sf_dir).select("id", "bucket", "role", "event")


@register("weighted_choice", f"SELECT id, shot FROM ({JOB})")
def q_weighted_choice(spark, sf_dir):
    """Shot type by cumulative weight."""
    return v_job(spark, sf_dir).select("id", "shot")


@register("mixture_rate", f"SELECT id, mismatch, back_raw FROM ({JOB})")
def q_mixture_rate(spark, sf_dir):
    """E5: absurd vs normal backdrop per candidate."""
    return v_job(spark, sf_dir).select("id", "mismatch", "back_raw")


_PROPS_SQL = ("coalesce(nullif(array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN mismatch THEN (CASE WHEN {Q.uniform(SEED, 'id', f'prop{i}')} < {ra!r} THEN {Q.q(pa)} END) "
    f"ELSE (CASE WHEN {Q.uniform(SEED, 'id', f'prop{i}')} < {rn!r} THEN {Q.q(pn)} END) END"
    for i, ((pa, ra), (pn, rn)) in enumerate(zip(V.PROPS_ABSURD, V.PROPS_NORMAL)))
    + "], lambda _x: _x IS NOT NULL), '; '), ''), " + Q.q(V.PROPS_DEFAULT) + ")")


@register("bernoulli_gate",
          f"SELECT id, {Q.uniform(SEED, 'id', 'when_u')} < {V.WHEN_RATE!r} AS use_when, {_PROPS_SQL} AS props FROM ({JOB})")
def q_bernoulli_gate(spark, sf_dir):
    """When-fragment gate and prop gates per job."""
    return v_job(spark, sf_dir).select("id", (uniform(SEED, F.col("id"), "when_u") < V.WHEN_RATE).alias("use_when"),
                                       SC.props(F.col("id"), F.col("mismatch"), SEED).alias("props"))


@register("scene_props", f"SELECT id, {_PROPS_SQL} AS props FROM ({JOB})")
def q_scene_props(spark, sf_dir):
    """C17 on absurd and normal scenes."""
    j = v_job(spark, sf_dir)
    return j.select("id", SC.props(F.col("id"), F.col("mismatch"), SEED).alias("props"))


_NO_TEXT = V.NO_TEXT_PREFIX + ", ".join(V.TEXT_BLACKLIST)
_PROMPT_SQL = ("concat_ws('; ', concat_ws(' ', role, event, CASE WHEN mismatch THEN " + Q.loc_phrase("back_raw")
               + " ELSE back_raw END), shot, " + Q.q(V.PROMPT_MIDDLE + V.FACE_HINT) + ", "
               + Q.choice(SEED, "id", "light", V.LIGHTING) + ", " + _PROPS_SQL + ", " + Q.q(_NO_TEXT)
               + ", CASE WHEN mismatch THEN " + Q.q(V.STYLE_ABSURD) + " ELSE " + Q.q(V.STYLE_NORMAL) + " END)")


@register("scene_prompt", f"SELECT id, md5({_PROMPT_SQL}) AS prompt_md5, length({_PROMPT_SQL}) AS prompt_len FROM ({JOB})")
def q_scene_prompt(spark, sf_dir):
    """Image prompt per job."""
    p = SC.with_prompt(v_job(spark, sf_dir), SEED)
    return p.select("id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").cast("bigint").alias("prompt_len"))


_RT = O.text_tags_sql("role", V.ROLE_RULES)
_ET = O.text_tags_sql("event", V.EVENT_TAGS)
_BT = O.text_tags_sql("back_raw", V.BACKDROP_TAGS)
_OV = "len(list_intersect({a}, {b})) > 0"
_MATCH = f"(({_OV.format(a='rt', b='et')}) AND (({_OV.format(a='rt', b='bt')}) OR ({_OV.format(a='et', b='bt')})))"
_TAGGED = f"SELECT *, {_RT} AS rt, {_ET} AS et, {_BT} AS bt FROM ({JOB})"


@register("role_tags", f"SELECT id, array_to_string({_RT}, ',') AS tags FROM ({JOB})")
def q_role_tags(spark, sf_dir):
    """Role -> sorted tag set (default community)."""
    return v_job(spark, sf_dir).select("id", _tags_str(TG.role_tags(F.col("role"))).alias("tags"))


@register("tag_union", f"SELECT id, array_to_string({O.tag_union_sql(_RT, _ET)}, ',') AS tags FROM ({JOB})")
def q_tag_union(spark, sf_dir):
    """D3 / J3."""
    j = v_job(spark, sf_dir)
    return j.select("id", _tags_str(TG.tag_union(TG.role_tags(F.col("role")), TG.text_tags(F.col("event"), V.EVENT_TAGS))).alias("tags"))


@register("semantic_match",
          f"SELECT id, array_to_string(rt, ',') AS role_tags, array_to_string(et, ',') AS event_tags, "
          f"array_to_string(bt, ',') AS back_tags, {_MATCH} AS matched FROM ({_TAGGED}) WHERE NOT mismatch")
def q_semantic_match(spark, sf_dir):
    """D4 / F3 on normal-backdrop jobs."""
    v = SC.with_validity(v_job(spark, sf_dir).filter(~F.col("mismatch")))
    return v.select("id", _tags_str("role_tags").alias("role_tags"), _tags_str("event_tags").alias("event_tags"),
                    _tags_str("back_tags").alias("back_tags"), F.col("valid").alias("matched"))


def _with_tag_choice(jobs):
    """D3 + D6 with every step a column of its own: the pick reads the tags several times, and must
    not repeat the keyword tests each time."""
    d = TG.add_text_tags(jobs, "role", "_rt", V.ROLE_RULES)
    d = TG.add_text_tags(d, "event", "_et", V.EVENT_TAGS)
    d = d.withColumn("_tags", TG.tag_union(F.col("_rt"), F.col("_et")))
    return d.withColumn("tag", TG.tag_choice(F.col("_tags"), SEED, F.col("id"), "tag"))


_TAGU = O.tag_union_sql(_RT, _ET)
_TAGC = f"coalesce({Q.choice_from(f'list_sort({_TAGU})', SEED, 'id', 'tag')}, 'community')"


@register("tag_choice", f"SELECT id, {_TAGC} AS tag FROM ({JOB})")
def q_tag_choice(spark, sf_dir):
    """Uniform pick from the sorted tag set."""
    return _with_tag_choice(v_job(spark, sf_dir)).select("id", "tag")


@register("object_lookup",
          f"SELECT id, tag, {Q.choice_from(O.objects_for_sql('tag'), SEED, 'id', 'obj')} AS object "
          f"FROM (SELECT id, CASE WHEN {Q.uniform(SEED, 'id', 'mediatag')} < 0.1 THEN 'media' ELSE {_TAGC} END AS tag FROM ({JOB}))")
def q_object_lookup(spark, sf_dir):
    """Objects by tag with the default-tag fallback (10% of jobs ask for
    'media', which has no object list)."""
    j = _with_tag_choice(v_job(spark, sf_dir))
    tag = F.when(uniform(SEED, F.col("id"), "mediatag") < 0.1, F.lit("media")).otherwise(F.col("tag"))
    d = j.select("id", tag.alias("tag")).withColumn("objects", TG.objects_for(F.col("tag")))
    return d.select("id", "tag", choice_from(F.col("objects"), SEED, F.col("id"), "obj").alias("object"))


_KW = " UNION ALL ".join(f"SELECT {Q.q(t)} AS tag, {Q.q(k)} AS keyword" for t, kws in V.EVENT_TAGS.items() for k in kws)


@register("text_tags",
          f"SELECT doc_id AS id, CASE WHEN count(tag) > 0 THEN array_to_string(list_sort(list_distinct(list(tag) FILTER (WHERE tag IS NOT NULL))), ',') "
          f"ELSE 'community' END AS tags FROM documents LEFT JOIN ({_KW}) k ON contains(lower(text), keyword) GROUP BY doc_id")
def q_text_tags(spark, sf_dir):
    """Keywords contained in whole documents, row by row: the keyword
    table is a parameter of fixed size, so no join and no shuffle is needed."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return TG.add_text_tags(d, "text", "tags", V.EVENT_TAGS).select("id", _tags_str("tags").alias("tags"))


_SCENE_SQL = (f"SELECT *, {_PROMPT_SQL} AS prompt FROM ({_TAGGED}) WHERE mismatch OR {_MATCH}")
_DEDUP_SQL = (f"SELECT * FROM ({_SCENE_SQL}) "
              f"QUALIFY row_number() OVER (PARTITION BY prompt, back_caption, shot, role, event ORDER BY id) = 1")
_POOL_SQL = (f"SELECT id, md5(prompt) AS prompt_md5, back_caption, shot, role, event, mismatch, "
             f"row_number() OVER (ORDER BY id) AS pool_pos FROM ({_DEDUP_SQL})")


@register("scene_pool", f"SELECT * FROM ({_POOL_SQL}) WHERE pool_pos <= (SELECT count(*) // {POOL_SHARE} FROM ({JOB}))")
def q_scene_pool(spark, sf_dir):
    """E8 + E9: the first valid, distinct scenes in job order, one for two jobs; all there are if
    that is fewer (the vocabulary has so many distinct scenes only)."""
    jobs = v_job(spark, sf_dir)
    p = SC.scene_pool(jobs, jobs.count() // POOL_SHARE, SEED, partial=True)
    return p.select("id", F.md5("prompt").alias("prompt_md5"), "back_caption", "shot", "role", "event", "mismatch",
                    F.col("pool_pos").cast("bigint").alias("pool_pos"))


@register("scene_distinct",
          f"SELECT id FROM ({_SCENE_SQL}) QUALIFY row_number() OVER (PARTITION BY prompt, back_caption, shot, role, event ORDER BY id) = 1")
def q_scene_distinct(spark, sf_dir):
    """First-wins distinct on the scene key over all valid candidates."""
    return SC.distinct_valid(v_job(spark, sf_dir), SEED).select("id")


@register("seeded_shuffle",
          f"SELECT doc_id AS id, row_number() OVER (ORDER BY {Q.draw(SEED, 'doc_id', 'shuffle')}, doc_id) AS pos FROM documents")
def q_seeded_shuffle(spark, sf_dir):
    """A seeded permutation of the documents: exact global rank on
    (draw, id), blocks cut on the 32-bit draw."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    d = d.withColumn("_k", draw(SEED, F.col("id"), "shuffle"))
    return ordered_rank(d, "_k", None, out="pos", bits=12, tiebreak=["id"]).select("id", "pos")


_SHUF_SQL = ("list_transform(list_sort([" + ", ".join(
    f"{{'d': {Q.draw(SEED, Q.q(r), 'shuffle')}, 'v': {Q.q(r)}}}" for r in V.ROLES) + "]), lambda s: s.v)")


@register("round_robin",
          f"SELECT id, ({_SHUF_SQL})[((row_number() OVER (ORDER BY accept_order) - 1) % {len(V.ROLES)}) + 1] AS role FROM ({JOB})")
def q_round_robin(spark, sf_dir):
    """Jobs in arrival order cycle through a seeded shuffle of the roles."""
    j = ordered_rank(v_job(spark, sf_dir).select("id", "accept_order"), "accept_order", None, out="rk", bits=16)
    roles = SC.shuffled(V.ROLES, SEED)
    return j.select("id", F.element_at(roles, (F.pmod(F.col("rk") - 1, F.lit(len(V.ROLES))) + 1).cast("int")).alias("role"))
