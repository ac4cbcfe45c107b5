"""Registered queries: fingerprints, near-duplicate joins and first-wins dedup
(K11, K12, F4-F6, G7, H1-H3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab as V
from ..operators import clusters as CL
from ..operators import dedup as D
from ..operators import neardup as N
from . import sqlgen as Q
from .registry import register
from .views import SEED, table, v_cap

# chain masks for planted near-duplicates: copy c of a vector flips these bits
DUP_MASKS = [0, 3, 15, 63]


def v_hash(spark, sf_dir):
    """One fingerprint per embedding."""
    e = table(spark, sf_dir, "embeddings")
    return N.add_fingerprint(e.select("vec_id", "label", "embedding"), "embedding", "h").drop("embedding")


def v_hash_dup(spark, sf_dir):
    """Four copies of every fingerprint with growing bit flips, so chains of
    near-duplicates exist (copy c differs from copy c-1 in 2 bits). Arrival
    order = id; caption shared by all rows with the same label and copy."""
    h = v_hash(spark, sf_dir)
    c = F.explode(F.array(*[F.lit(i) for i in range(len(DUP_MASKS))])).alias("c")
    masks = F.array(*[F.lit(m).cast("bigint") for m in DUP_MASKS])
    d = h.select("vec_id", "label", "h", c)
    return d.select((F.col("vec_id") * 4 + F.col("c")).alias("id"), (F.col("vec_id") * 4 + F.col("c")).alias("accept_order"),
                    "c", F.col("h").bitwiseXOR(F.element_at(masks, F.col("c") + 1)).alias("h"),
                    F.concat(F.lit("caption "), F.col("label").cast("string"), F.lit(" "), F.col("c").cast("string")).alias("text"))


FP_SQL = """list_reduce(list_transform(range(64), lambda i: CASE WHEN cast(embedding[i + 1] AS DOUBLE) >
  (cast(list_sort(embedding)[32] AS DOUBLE) + cast(list_sort(embedding)[33] AS DOUBLE)) / 2.0
  THEN (CASE WHEN i = 63 THEN (-9223372036854775807 - 1) ELSE (cast(1 AS BIGINT) << i) END) ELSE cast(0 AS BIGINT) END),
  lambda a, b: a | b)"""
V_HASH_SQL = f"SELECT vec_id, label, {FP_SQL} AS h FROM embeddings"
V_HASH_DUP_SQL = (f"SELECT vec_id * 4 + c AS id, vec_id * 4 + c AS accept_order, c, "
                  f"xor(h, ({DUP_MASKS})[c + 1]) AS h, 'caption ' || cast(label AS VARCHAR) || ' ' || cast(c AS VARCHAR) AS text "
                  f"FROM ({V_HASH_SQL}) CROSS JOIN (SELECT unnest(range({len(DUP_MASKS)})) AS c)")


@register("fingerprint64", f"SELECT vec_id, h, cast(bit_count(h) AS INTEGER) AS ones FROM ({V_HASH_SQL})")
def q_fingerprint64(spark, sf_dir):
    return v_hash(spark, sf_dir).select("vec_id", "h", F.bit_count("h").cast("int").alias("ones"))


@register("hamming", f"SELECT a.vec_id, cast(bit_count(xor(a.h, b.h)) AS INTEGER) AS dist "
                     f"FROM ({V_HASH_SQL}) a JOIN ({V_HASH_SQL}) b ON b.vec_id = a.vec_id + 1")
def q_hamming(spark, sf_dir):
    """K12 between consecutive embeddings (one partner each)."""
    a = v_hash(spark, sf_dir)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("h").alias("h2"))
    return a.join(b, "vec_id").select("vec_id", N.hamming(F.col("h"), F.col("h2")).alias("dist"))


_HV = f"SELECT DISTINCT h FROM ({V_HASH_DUP_SQL})"


@register("near_dup_pairs",
          f"SELECT a.h AS ha, b.h AS hb, cast(bit_count(xor(a.h, b.h)) AS INTEGER) AS dist "
          f"FROM ({_HV}) a JOIN ({_HV}) b ON a.h < b.h AND bit_count(xor(a.h, b.h)) <= {V.PHASH_DISTANCE_MAX}")
def q_near_dup_pairs(spark, sf_dir):
    """exact banded join on distinct hash values."""
    return N.near_pairs(v_hash_dup(spark, sf_dir))


@register("near_dup_pairs_wide",
          f"SELECT a.h AS ha, b.h AS hb, cast(bit_count(xor(a.h, b.h)) AS INTEGER) AS dist "
          f"FROM ({_HV}) a JOIN ({_HV}) b ON a.h < b.h AND bit_count(xor(a.h, b.h)) <= {V.PHASH_DISTANCE_MAX}")
def q_near_dup_pairs_wide(spark, sf_dir):
    """F5 with 7 bands (35 keys of ~37 bits each): the setting for very large
    hash sets, where 16-bit keys would collect too many candidates."""
    return N.near_pairs(v_hash_dup(spark, sf_dir), bands=7)


@register("near_dup_anti",
          f"SELECT n.id, n.h FROM ({V_HASH_DUP_SQL}) n WHERE n.c > 0 AND NOT EXISTS "
          f"(SELECT 1 FROM ({V_HASH_DUP_SQL}) s WHERE s.c = 0 AND bit_count(xor(s.h, n.h)) <= {V.PHASH_DISTANCE_MAX})")
def q_near_dup_anti(spark, sf_dir):
    """later copies (c > 0) not within distance 3 of any stored base hash."""
    d = v_hash_dup(spark, sf_dir)
    return N.near_dup_anti(d.filter("c > 0"), d.filter("c = 0")).select("id", "h")


def greedy_sql(columns: str, conflict: str, rounds: int, source: str = V_HASH_DUP_SQL) -> str:
    """First-wins selection (by id) in rounds: a row without an earlier undecided or kept conflict is kept, one with an
    earlier kept conflict is dropped. A row left undecided after the last round fails the query."""
    ctes = [f"d AS MATERIALIZED ({source})",
            f"x AS MATERIALIZED (SELECT a.id AS early, b.id AS late FROM d a JOIN d b ON a.id < b.id AND ({conflict}))",
            "u0 AS MATERIALIZED (SELECT id FROM d)", "k0 AS MATERIALIZED (SELECT id FROM d WHERE false)"]
    for r in range(1, rounds + 1):
        ctes += [f"n{r} AS MATERIALIZED (SELECT id FROM u{r - 1} WHERE id NOT IN (SELECT late FROM x WHERE early IN (SELECT id FROM u{r - 1}) OR early IN (SELECT id FROM k{r - 1})))",
                 f"k{r} AS MATERIALIZED (SELECT id FROM k{r - 1} UNION ALL SELECT id FROM n{r})",
                 f"u{r} AS MATERIALIZED (SELECT id FROM u{r - 1} WHERE id NOT IN (SELECT id FROM n{r}) AND id NOT IN (SELECT late FROM x WHERE early IN (SELECT id FROM n{r})))"]
    return (f"WITH {', '.join(ctes)} SELECT {columns} FROM d WHERE id IN (SELECT id FROM k{rounds}) "
            f"AND CASE WHEN (SELECT count(*) FROM u{rounds}) > 0 THEN error('undecided rows') ELSE true END")


_NEAR = f"bit_count(xor(a.h, b.h)) <= {V.PHASH_DISTANCE_MAX}"


@register("near_dup_greedy", greedy_sql("id, h", _NEAR, 8))
def q_near_dup_greedy(spark, sf_dir):
    """H2: greedy first-wins near-dup dedup (kept rows)."""
    d = v_hash_dup(spark, sf_dir)
    edges = N.neighbour_edges(N.near_pairs(d))
    out = D.greedy_keep(d.select("id", "accept_order", "h"), "accept_order", [("h", edges)])
    return out.filter("kept").select("id", "h")


@register("joint_dedup", greedy_sql("id, h, text", f"{_NEAR} OR a.text = b.text", 12))
def q_joint_dedup(spark, sf_dir):
    """H3: a row conflicts with an earlier kept row on a near hash OR the same
    caption; a rejected row registers neither."""
    d = v_hash_dup(spark, sf_dir)
    edges = N.neighbour_edges(N.near_pairs(d))
    out = D.greedy_keep(d.select("id", "accept_order", "h", "text"), "accept_order", [("h", edges), ("text", None)])
    return out.filter("kept").select("id", "h", "text")


@register("caption_dedup",
          "SELECT doc_id AS id, md5(text) AS text_md5 FROM documents "
          "QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def q_caption_dedup(spark, sf_dir):
    """H1: first-wins exact caption dedup in arrival (id) order."""
    c = v_cap(spark, sf_dir).withColumn("accept_order", F.col("id"))
    return D.first_wins(c, ["text"]).select("id", F.md5("text").alias("text_md5"))


@register("caption_anti",
          "SELECT doc_id AS id FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM labels) "
          "AND NOT EXISTS (SELECT 1 FROM documents s JOIN labels l ON s.doc_id = l.doc_id WHERE s.text = d.text)")
def q_caption_anti(spark, sf_dir):
    """Unlabelled documents whose text was not already accepted
    (accepted = the labelled documents)."""
    docs = v_cap(spark, sf_dir)
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    seen = docs.join(lab, "id", "left_semi")
    new = docs.join(lab, "id", "left_anti")
    return D.anti_seen(new, seen, "text").select("id")


@register("distinct_captions",
          "SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct FROM documents")
def q_distinct_captions(spark, sf_dir):
    """G7."""
    return v_cap(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("text").alias("n_distinct"))


_EDGES = f"SELECT a.h AS a, b.h AS b FROM ({_HV}) a JOIN ({_HV}) b ON a.h <> b.h AND {_NEAR}"
CLUSTERS_SQL = (f"WITH RECURSIVE e AS MATERIALIZED ({_EDGES}), r(a, b) AS (SELECT h, h FROM ({_HV}) UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) "
             f"SELECT a AS h, min(b) AS cluster FROM r GROUP BY a")


@register("near_clusters", f"SELECT h, cluster FROM ({CLUSTERS_SQL})")
def q_near_clusters(spark, sf_dir):
    """Clusters of fingerprints, chained through near ones."""
    return CL.near_clusters(v_hash_dup(spark, sf_dir))


@register("split_assign_near",
          f"SELECT id, cluster, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split FROM "
          f"(SELECT d.id, c.cluster, {Q.uniform(SEED, 'c.cluster', 'split')} AS u FROM ({V_HASH_DUP_SQL}) d JOIN ({CLUSTERS_SQL}) c ON d.h = c.h)")
def q_split_assign_near(spark, sf_dir):
    """Train / validation / test by cluster of near images, so none straddles a border."""
    return CL.split_near(v_hash_dup(spark, sf_dir).select("id", "h"), SEED).select("id", "cluster", "split")
