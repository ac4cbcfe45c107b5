"""Registered queries: flagship caption path and the text / grammar operators (C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as T
from ..operators import captions as CAP
from . import oracle as O
from . import sqlgen as Q
from ..session import cut_lineage
from .pipeline import GOAL_SHARE, caption_records, records_as_text
from .registry import register
from .views import SEED, table, v_cap, v_job

JOB = O.v_job_sql()
CAPS = O.captions_sql(f"SELECT * FROM ({JOB})")
GOAL_SQL = (f"SELECT bucket AS gb, cast(floor(count(*) * CASE bucket " + " ".join(f"WHEN '{k}' THEN cast({v} AS DOUBLE)" for k, v in GOAL_SHARE.items())
            + f" END) AS BIGINT) AS goal FROM ({JOB}) GROUP BY bucket")

_HEAD = f"""
WITH cap AS ({CAPS}),
d AS (SELECT * FROM cap QUALIFY row_number() OVER (PARTITION BY text ORDER BY accept_order) = 1),
f AS (SELECT d.* FROM d JOIN ({GOAL_SQL}) ON bucket = gb QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY accept_order) <= goal)
"""
_RECORD = f"""SELECT id, {O.image_path_sql('bucket', 'id')} AS image, text, fake_cls, '' AS fake_image_box,
       {Q.ints_to_str('fake_text_pos')} AS fake_text_pos, '' AS mtcnn_boxes"""
FLAGSHIP_SQL = f"{_HEAD}{_RECORD} FROM f"
ALL_RECORDS_SQL = f"{_HEAD}{_RECORD} FROM d"


@register("caption_records", FLAGSHIP_SQL)
def q_caption_records(spark, sf_dir):
    return records_as_text(caption_records(spark, sf_dir))


# ---- C3 tidy steps and C14 tokens over whole document texts ---------------

def _doc_op(name, col_fn, sql_fn):
    def q(spark, sf_dir):
        r = col_fn(F.col("text"))
        return v_cap(spark, sf_dir).select("id", F.md5(r).alias("out_md5"), F.length(r).cast("bigint").alias("out_len"))
    sql = (f"SELECT doc_id AS id, md5(_r) AS out_md5, cast(length(_r) AS bigint) AS out_len "
           f"FROM (SELECT doc_id, {sql_fn('text')} AS _r FROM documents)")
    register(name, sql)(q)


_doc_op("tidy_ws", T.collapse_ws, Q.collapse_ws)
_doc_op("tidy_punct", T.tidy_punct, Q.tidy_punct)
_doc_op("tidy_prep", T.tidy_prep, Q.tidy_prep)
_doc_op("tidy_capital", T.tidy_capital, Q.tidy_capital)
_doc_op("tidy_terminal", T.tidy_terminal, Q.tidy_terminal)
_doc_op("headline_tidy", T.headline_tidy, Q.headline_tidy)
_doc_op("clean_event", T.clean_event, Q.clean_event)
_doc_op("caption_backdrop", T.caption_backdrop, Q.caption_backdrop)


@register("token_count", f"SELECT doc_id AS id, cast({Q.token_count('text')} AS bigint) AS n_tokens FROM documents")
def q_token_count(spark, sf_dir):
    return v_cap(spark, sf_dir).select("id", T.token_count(F.col("text")).cast("bigint").alias("n_tokens"))


@register("caption_length_qc",
          f"SELECT id, n_tokens FROM (SELECT doc_id AS id, cast({Q.token_count('text')} AS bigint) AS n_tokens "
          f"FROM documents) WHERE n_tokens BETWEEN 10 AND 25")
def q_caption_length_qc(spark, sf_dir):
    """Caption length gate 10..25 tokens."""
    n = T.token_count(F.col("text")).cast("bigint")
    return v_cap(spark, sf_dir).select("id", n.alias("n_tokens")).filter(F.col("n_tokens").between(10, 25))


# ---- C1, C2, C4, C6, C15 over part names ----------------------------------

@register("is_plural", f"SELECT p_partkey AS id, {Q.is_plural_subject('p_name')} AS plural FROM part")
def q_is_plural(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"),
                                               T.is_plural_subject(F.col("p_name")).alias("plural"))


_LAST = "({t})[-1]"
_FIRST_TYPE = f"({Q.tokens('p_type')})[1]"


@register("conjugate",
          f"SELECT p_partkey AS id, {Q.conjugate_third_person(_LAST.format(t=Q.tokens('p_name')), Q.is_plural_subject(_FIRST_TYPE))} AS verb "
          f"FROM part")
def q_conjugate(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    base = F.element_at(T.tokens(F.col("p_name")), -1)
    plural = T.is_plural_subject(F.element_at(T.tokens(F.col("p_type")), 1))
    return p.select(F.col("p_partkey").alias("id"), T.conjugate_third_person(base, plural).alias("verb"))


@register("role_to_subject",
          "SELECT p_partkey AS id, " + Q.role_to_subject("'a ' || p_type || ' ' || p_name") + " AS subject FROM part")
def q_role_to_subject(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    T.role_to_subject(F.concat(F.lit("a "), F.col("p_type"), F.lit(" "), F.col("p_name"))).alias("subject"))


@register("loc_phrase",
          "SELECT p_partkey AS id, " + Q.loc_phrase("lower(p_type) || ' ' || p_name") + " AS phrase FROM part")
def q_loc_phrase(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    T.loc_phrase(F.concat(F.lower(F.col("p_type")), F.lit(" "), F.col("p_name"))).alias("phrase"))


@register("split_verb",
          "SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS first_word, "
          "CASE WHEN contains(p_name, ' ') THEN substr(p_name, strpos(p_name, ' ') + 1) END AS remainder FROM part")
def q_split_verb(spark, sf_dir):
    """Split a phrase into first word and remainder."""
    parts = F.split(F.col("p_name"), " ", 2)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.element_at(parts, 1).alias("first_word"),
        F.when(F.size(parts) > 1, F.element_at(parts, 2)).alias("remainder"))


# ---- C8-C13 over caption jobs ---------------------------------------------

@register("newsroom_headline",
          "SELECT id, text FROM (" + O.captions_sql("SELECT * EXCLUDE (bucket), 'lit' AS bucket FROM (" + JOB + ")") + ")")
def q_newsroom_headline(spark, sf_dir):
    """C9 for every job (literal class)."""
    jobs = v_job(spark, sf_dir).withColumn("bucket", F.lit("lit"))
    return CAP.with_captions(jobs, SEED).select("id", "text")


_TA_SRC = f"SELECT * EXCLUDE (bucket), 'inv' AS bucket FROM ({JOB})"


@register("ta_caption", f"SELECT id, text FROM ({O.captions_sql(_TA_SRC)})")
def q_ta_caption(spark, sf_dir):
    """C10 for every job."""
    jobs = v_job(spark, sf_dir).withColumn("bucket", F.lit("inv"))
    return CAP.with_captions(jobs, SEED).select("id", "text")


@register("ta_span", f"SELECT e.id, {Q.ints_to_str('e.fake_text_pos')} AS span_exact, "
                     f"{Q.ints_to_str('r.fake_text_pos')} AS span_reference "
                     f"FROM ({O.captions_sql(_TA_SRC)}) e JOIN ({O.captions_sql(_TA_SRC, span_mode='reference')}) r "
                     f"ON e.id = r.id")
def q_ta_span(spark, sf_dir):
    """C11 in both span modes."""
    jobs = v_job(spark, sf_dir).withColumn("bucket", F.lit("inv"))
    both = CAP.with_captions(jobs, SEED, CAP.SPAN_MODES).select("id", *[T.ints_to_str(f"fake_text_pos_{m}").alias(f"span_{m}") for m in CAP.SPAN_MODES])
    both = cut_lineage(both)  # the captions are made once
    return both.select("id", "span_exact").join(both.select("id", "span_reference"), "id")


_TS_SRC = f"SELECT * EXCLUDE (bucket), 'irr' AS bucket FROM ({JOB})"


@register("ts_caption", f"SELECT id, text, {Q.ints_to_str('fake_text_pos')} AS span FROM ({O.captions_sql(_TS_SRC)})")
def q_ts_caption(spark, sf_dir):
    """C12 + C13 for every job."""
    jobs = v_job(spark, sf_dir).withColumn("bucket", F.lit("irr"))
    return CAP.with_captions(jobs, SEED).select("id", "text", T.ints_to_str("fake_text_pos").alias("span"))


@register("render_pattern",
          f"SELECT id, {Q.render_pattern(Q.pick_index(SEED, 'id', 'pattern', len(V.PATTERNS)), {'S': Q.role_to_subject('role'), 'V': Q.q('reviews'), 'O': Q.q('the plan'), 'B': 'back_caption', 'E': Q.clean_event('event'), 'D': 'dateline', 'W': Q.q('')})} AS core FROM ({JOB})")
def q_render_pattern(spark, sf_dir):
    """Template fill (before tidy) for every job."""
    j = v_job(spark, sf_dir)
    k = CAP.pick_index(SEED, F.col("id"), "pattern", len(V.PATTERNS))
    slots = {"S": T.role_to_subject(F.col("role")), "V": F.lit("reviews"), "O": F.lit("the plan"),
             "B": F.col("back_caption"), "E": T.clean_event(F.col("event")), "D": F.col("dateline"), "W": F.lit("")}
    return j.select("id", T.render_pattern(k, slots).alias("core"))
