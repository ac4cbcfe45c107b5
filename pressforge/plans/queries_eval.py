"""Registered queries: scoring, ranking and release checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.sampling import uniform
from ..operators import evaluate as EV
from . import sqlgen as Q
from .registry import register
from .views import SEED, table, v_job
from . import oracle as O

GOLD_RATE, PRED_GOLD_RATE, PRED_EXTRA_RATE = 0.3, 0.25, 0.05
N_TEAMS = 5


def _tok_key(p):
    return F.concat(F.col("id").cast("string"), F.lit(":"), p.cast("string"))


def v_eval(spark, sf_dir, team=None):
    """Gold labels / types / token sets from labels x documents, and one
    predictor's output (team ``t`` flips labels at rate 0.1 + 0.05 t;
    default predictor 0.2)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "text")
    j = lab.join(doc, "doc_id").select(F.col("doc_id").alias("id"), "quality", "toxic", "text")
    gm = F.col("quality") == 0
    d = j.select("*", F.when(gm, F.lit(EV.POS)).otherwise(F.lit(EV.NEG)).alias("gold_label"),
                 F.when(gm, F.when(F.col("toxic") == 1, F.lit("text_swap")).otherwise(F.lit("text_attribute")))
                 .otherwise(F.lit("origin")).alias("gold_type"),
                 T.token_count(F.col("text")).alias("n_tok"))
    rng = T.index_range(F.lit(0), F.col("n_tok"))
    d = d.withColumn("gold_tokens", F.when(gm, F.filter(rng, lambda p: uniform(SEED, _tok_key(p), "gold") < GOLD_RATE))
                     .otherwise(T.empty_int_array()))
    if team is not None:
        # gold is the same for every team: computed once, then one row per team
        d = d.withColumn("team", team)
    sfx = F.lit("") if team is None else F.col("team").cast("string")
    rate = F.lit(0.2) if team is None else F.lit(0.1) + F.col("team") * F.lit(0.05)
    flip = uniform(SEED, F.col("id"), F.concat(F.lit("flip"), sfx)) < rate
    pred_m = (gm & ~flip) | (~gm & flip)
    u_conf = uniform(SEED, F.col("id"), F.concat(F.lit("conf"), sfx))
    u_type = uniform(SEED, F.col("id"), F.concat(F.lit("type"), sfx))
    other = F.when(F.col("gold_type") == "text_swap", F.lit("text_attribute")).otherwise(F.lit("text_swap"))
    d = d.select("*", F.when(pred_m, F.lit(EV.POS)).otherwise(F.lit(EV.NEG)).alias("pred_label"),
                 F.when(pred_m, F.lit(0.5) + F.lit(0.5) * u_conf).otherwise(F.lit(0.5) * u_conf).alias("confidence"),
                 F.when(~pred_m, F.lit("origin"))
                 .when(gm, F.when(u_type < 0.75, F.col("gold_type")).otherwise(other))
                 .when(u_type < 0.5, F.lit("text_swap")).otherwise(F.lit("text_attribute")).alias("pred_type"))
    pslot = F.concat(F.lit("pred"), sfx)
    return d.withColumn("pred_tokens", F.when(F.col("pred_label") == EV.POS, F.filter(
        rng, lambda p: (uniform(SEED, _tok_key(p), "gold") < PRED_GOLD_RATE) | (uniform(SEED, _tok_key(p), pslot) < PRED_EXTRA_RATE)))
        .otherwise(T.empty_int_array()))


def v_eval_sql(team: str | None = None) -> str:
    sfx = "''" if team is None else f"cast({team} AS VARCHAR)"
    rate = "0.2" if team is None else f"(0.1 + {team} * 0.05)"
    key = "cast(id AS VARCHAR) || ':' || cast(p AS VARCHAR)"
    u_gold = Q.uniform(SEED, key, "gold")
    base = ("SELECT doc_id AS id, quality, toxic, text" + ("" if team is None else f", {team} AS team")
            + " FROM labels JOIN documents USING (doc_id)" + ("" if team is None else f" CROSS JOIN (SELECT unnest(range({N_TEAMS})) AS {team})"))

    def u(slot):
        return f"({Q.draw(SEED, 'id', f'{Q.q(slot)} || {sfx}', slot_is_sql=True)} / 4294967296.0)"
    s1 = (f"SELECT *, CASE WHEN quality = 0 THEN 'manipulated' ELSE 'authentic' END AS gold_label, "
          f"CASE WHEN quality = 0 THEN (CASE WHEN toxic = 1 THEN 'text_swap' ELSE 'text_attribute' END) ELSE 'origin' END AS gold_type, "
          f"{Q.token_count('text')} AS n_tok, ({u('flip')} < {rate}) AS _flip, {u('conf')} AS _uc, {u('type')} AS _ut FROM ({base})")
    s2 = (f"SELECT *, CASE WHEN quality = 0 THEN list_filter(range(0, n_tok), lambda p: {u_gold} < {GOLD_RATE}) ELSE [] END AS gold_tokens, "
          f"((quality = 0 AND NOT _flip) OR (quality <> 0 AND _flip)) AS _pm FROM ({s1})")
    pslot = f"'pred' || {sfx}"
    u_pred = f"({Q.draw(SEED, key, pslot, slot_is_sql=True)} / 4294967296.0)"
    s3 = (f"SELECT * EXCLUDE (_flip, _uc, _ut, _pm), CASE WHEN _pm THEN 'manipulated' ELSE 'authentic' END AS pred_label, "
          f"CASE WHEN _pm THEN 0.5 + 0.5 * _uc ELSE 0.5 * _uc END AS confidence, "
          f"CASE WHEN NOT _pm THEN 'origin' WHEN quality = 0 THEN (CASE WHEN _ut < 0.75 THEN gold_type "
          f"WHEN gold_type = 'text_swap' THEN 'text_attribute' ELSE 'text_swap' END) "
          f"WHEN _ut < 0.5 THEN 'text_swap' ELSE 'text_attribute' END AS pred_type, "
          f"CASE WHEN _pm THEN list_filter(range(0, n_tok), lambda p: {Q.uniform(SEED, key, 'gold')} < {PRED_GOLD_RATE} "
          f"OR {u_pred} < {PRED_EXTRA_RATE}) ELSE [] END AS pred_tokens FROM ({s2})")
    return s3


EV_SQL = v_eval_sql()
_F1 = "CASE WHEN 2.0 * tp + fp + fn > 0 THEN 2.0 * tp / (2.0 * tp + fp + fn) ELSE 0.0 END"
_CNT = ("sum(CASE WHEN gold_label = 'manipulated' AND pred_label = 'manipulated' THEN 1 ELSE 0 END) AS tp, "
        "sum(CASE WHEN gold_label <> 'manipulated' AND pred_label = 'manipulated' THEN 1 ELSE 0 END) AS fp, "
        "sum(CASE WHEN gold_label = 'manipulated' AND pred_label <> 'manipulated' THEN 1 ELSE 0 END) AS fn")


def _r(df, cols):
    return df.select(*[F.round(F.col(c), 6).alias(c) if c not in ("tp", "fp", "fn", "team", "rank") else F.col(c) for c in cols])


@register("eval_accuracy", f"SELECT round(avg(CASE WHEN gold_label = pred_label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ({EV_SQL})")
def q_eval_accuracy(spark, sf_dir):
    return _r(EV.accuracy(v_eval(spark, sf_dir)), ["accuracy"])


@register("eval_f1_binary",
          f"SELECT cast(tp AS BIGINT) AS tp, cast(fp AS BIGINT) AS fp, cast(fn AS BIGINT) AS fn, "
          f"round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision, "
          f"round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall, round({_F1}, 6) AS f1_binary "
          f"FROM (SELECT {_CNT} FROM ({EV_SQL}))")
def q_eval_f1_binary(spark, sf_dir):
    return _r(EV.f1_binary(v_eval(spark, sf_dir)), ["tp", "fp", "fn", "precision", "recall", "f1_binary"])


@register("eval_auc",
          f"WITH s AS (SELECT confidence, sum(CASE WHEN gold_label = 'manipulated' THEN 1 ELSE 0 END) AS p, "
          f"sum(CASE WHEN gold_label <> 'manipulated' THEN 1 ELSE 0 END) AS n FROM ({EV_SQL}) GROUP BY confidence), "
          f"c AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY confidence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM s) "
          f"SELECT round(sum(p * (nb + 0.5 * n)) / (sum(p) * sum(n)), 6) AS auc FROM c")
def q_eval_auc(spark, sf_dir):
    return _r(EV.roc_auc(v_eval(spark, sf_dir)), ["auc"])


_TYPE_SQL = " ".join(
    f", sum(CASE WHEN gold_type = '{t}' AND pred_type = '{t}' THEN 1 ELSE 0 END) AS tp_{t}"
    f", sum(CASE WHEN gold_type <> '{t}' AND pred_type = '{t}' THEN 1 ELSE 0 END) AS fp_{t}"
    f", sum(CASE WHEN gold_type = '{t}' AND pred_type <> '{t}' THEN 1 ELSE 0 END) AS fn_{t}" for t in EV.TYPES)
_TYPE_F1 = " + ".join(f"(CASE WHEN 2.0 * tp_{t} + fp_{t} + fn_{t} > 0 THEN 2.0 * tp_{t} / (2.0 * tp_{t} + fp_{t} + fn_{t}) ELSE 0.0 END)"
                      for t in EV.TYPES)


@register("eval_type",
          f"SELECT round(coalesce(acc, 0.0), 6) AS type_accuracy, round(({_TYPE_F1}) / {float(len(EV.TYPES))}, 6) AS f1_type "
          f"FROM (SELECT avg(CASE WHEN gold_type = pred_type THEN 1.0 ELSE 0.0 END) AS acc {_TYPE_SQL} "
          f"FROM ({EV_SQL}) WHERE gold_label = 'manipulated')")
def q_eval_type(spark, sf_dir):
    return _r(EV.type_scores(v_eval(spark, sf_dir)), ["type_accuracy", "f1_type"])


_TOK_SQL = (f"SELECT len(list_intersect(gold_tokens, pred_tokens)) AS i, len(gold_tokens) AS g, len(pred_tokens) AS p "
            f"FROM ({EV_SQL}) WHERE gold_label = 'manipulated'")


@register("eval_token_f1",
          f"SELECT round(CASE WHEN tp > 0 THEN ti / tp ELSE 0.0 END, 6) AS token_precision, "
          f"round(CASE WHEN tg > 0 THEN ti / tg ELSE 0.0 END, 6) AS token_recall, "
          f"round(CASE WHEN tp + tg > 0 THEN 2.0 * ti / (tp + tg) ELSE 0.0 END, 6) AS f1_text, "
          f"round(coalesce(mf, 0.0), 6) AS token_macro_f1 FROM (SELECT sum(i) AS ti, sum(g) AS tg, sum(p) AS tp, "
          f"avg(CASE WHEN g + p = 0 THEN 1.0 ELSE 2.0 * i / (g + p) END) AS mf FROM ({_TOK_SQL}))")
def q_eval_token_f1(spark, sf_dir):
    return _r(EV.token_scores(v_eval(spark, sf_dir)), ["token_precision", "token_recall", "f1_text", "token_macro_f1"])


def _score_sql(src: str, group: str = "") -> str:
    sel = f"{group}, " if group else ""
    inner = (f"SELECT {sel}{_CNT}, sum(CASE WHEN gold_label = 'manipulated' THEN len(list_intersect(gold_tokens, pred_tokens)) END) AS ti, "
             f"sum(CASE WHEN gold_label = 'manipulated' THEN len(gold_tokens) END) AS tg, "
             f"sum(CASE WHEN gold_label = 'manipulated' THEN len(pred_tokens) END) AS tq"
             + _TYPE_SQL.replace("CASE WHEN gold_type", "CASE WHEN gold_label = 'manipulated' AND gold_type")
             + f" FROM ({src})" + (f" GROUP BY {group}" if group else ""))
    ft = "CASE WHEN coalesce(tq, 0) + coalesce(tg, 0) > 0 THEN 2.0 * coalesce(ti, 0) / (coalesce(tq, 0) + coalesce(tg, 0)) ELSE 0.0 END"
    return (f"SELECT {sel}{_F1} AS f1_binary, {ft} AS f1_text, ({_TYPE_F1}) / {float(len(EV.TYPES))} AS f1_type "
            f"FROM ({inner})")


@register("eval_score",
          f"SELECT round(f1_binary, 6) AS f1_binary, round(f1_text, 6) AS f1_text, round(f1_type, 6) AS f1_type, "
          f"round(0.5 * f1_binary + 0.3 * f1_text + 0.2 * f1_type, 6) AS score FROM ({_score_sql(EV_SQL)})")
def q_eval_score(spark, sf_dir):
    return _r(EV.final_score(v_eval(spark, sf_dir)), ["f1_binary", "f1_text", "f1_type", "score"])


@register("confusion",
          f"SELECT gold_label, cast(sum(CASE WHEN pred_label = 'authentic' THEN 1 ELSE 0 END) AS BIGINT) AS authentic, "
          f"cast(sum(CASE WHEN pred_label = 'manipulated' THEN 1 ELSE 0 END) AS BIGINT) AS manipulated FROM ({EV_SQL}) GROUP BY gold_label")
def q_confusion(spark, sf_dir):
    return EV.confusion(v_eval(spark, sf_dir))


@register("failure_cases", f"SELECT id, gold_label, pred_label FROM ({EV_SQL}) WHERE gold_label <> pred_label")
def q_failure_cases(spark, sf_dir):
    return v_eval(spark, sf_dir).filter(F.col("gold_label") != F.col("pred_label")).select("id", "gold_label", "pred_label")


@register("leaderboard",
          f"SELECT team, round(score, 6) AS score, cast(rank() OVER (ORDER BY score DESC) AS INTEGER) AS rank FROM "
          f"(SELECT team, 0.5 * f1_binary + 0.3 * f1_text + 0.2 * f1_type AS score FROM ({_score_sql(v_eval_sql('team'), 'team')}))")
def q_leaderboard(spark, sf_dir):
    """H8: five predictors scored per team in one grouped pass, then ranked."""
    teams = F.explode(F.sequence(F.lit(0), F.lit(N_TEAMS - 1)))
    d = v_eval(spark, sf_dir, team=teams)
    s = EV.final_score(d, group=["team"])
    return EV.leaderboard(s).select("team", F.round("score", 6).alias("score"), F.col("rank").cast("int").alias("rank"))


@register("submission_coverage",
          "SELECT doc_id AS id, 'missing' AS status FROM labels WHERE " + Q.uniform(SEED, "doc_id", "drop") + " < 0.03 "
          "UNION ALL SELECT doc_id AS id, 'unknown' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) "
          "AND " + Q.uniform(SEED, "doc_id", "extra") + " < 0.05")
def q_submission_coverage(spark, sf_dir):
    """gold ids without a prediction and predicted ids without gold
    (anti-joins both ways). The submission drops 3% of gold ids and adds 5%
    of unlabelled documents."""
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    sub = (lab.filter(uniform(SEED, F.col("id"), "drop") >= 0.03)
           .unionByName(docs.join(lab, "id", "left_anti").filter(uniform(SEED, F.col("id"), "extra") < 0.05)))
    missing = lab.join(sub, "id", "left_anti").withColumn("status", F.lit("missing"))
    unknown = sub.join(lab, "id", "left_anti").withColumn("status", F.lit("unknown"))
    return missing.unionByName(unknown)


@register("split_assign",
          f"SELECT doc_id AS id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split "
          f"FROM (SELECT doc_id, {Q.uniform(SEED, 'md5(text)', 'split')} AS u FROM documents)")
def q_split_assign(spark, sf_dir):
    """Split by the exact-duplicate group (md5 of the text)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), EV.split_assign(d, F.md5("text"), SEED).alias("split"))


@register("public_release",
          f"SELECT doc_id AS id, split, CASE WHEN split = 'test' THEN NULL ELSE CASE WHEN quality = 0 THEN 'manipulated' "
          f"ELSE 'authentic' END END AS label FROM (SELECT doc_id, quality, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 "
          f"THEN 'validation' ELSE 'test' END AS split FROM (SELECT l.doc_id, quality, {Q.uniform(SEED, 'md5(text)', 'split')} AS u "
          f"FROM labels l JOIN documents d ON l.doc_id = d.doc_id))")
def q_public_release(spark, sf_dir):
    """P5: labels hidden for the test split."""
    lab = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    j = lab.join(d, "doc_id").withColumn("split", EV.split_assign(None, F.md5("text"), SEED))
    label = F.when(F.col("quality") == 0, F.lit(EV.POS)).otherwise(F.lit(EV.NEG))
    return j.select(F.col("doc_id").alias("id"), "split", F.when(F.col("split") != "test", label).alias("label"))


@register("authenticity_label",
          f"SELECT id, bucket, CASE WHEN bucket = 'lit' THEN 'authentic' ELSE 'manipulated' END AS label FROM ({O.v_job_sql()})")
def q_authenticity_label(spark, sf_dir):
    """P2 over every caption job's class."""
    j = v_job(spark, sf_dir)
    cls = F.when(F.col("bucket") == "lit", F.lit("origin")).otherwise(F.lit("manip"))
    return j.select("id", "bucket", EV.authenticity_label(cls).alias("label"))


_ONCE_SQL = (f"SELECT id, CASE WHEN {Q.uniform(SEED, 'id', 'badlab')} < 0.02 THEN 'Manipulated' ELSE pred_label END AS label, "
            f"CASE WHEN {Q.uniform(SEED, 'id', 'badconf')} < 0.02 THEN confidence + 1.0 ELSE confidence END AS confidence, "
            f"CASE WHEN {Q.uniform(SEED, 'id', 'badtype')} < 0.02 THEN 'text_swap' ELSE pred_type END AS manipulation_type, "
            f"CASE WHEN {Q.uniform(SEED, 'id', 'badtok')} < 0.02 THEN list_append(pred_tokens, n_tok) ELSE pred_tokens END AS tokens, "
            f"n_tok FROM ({EV_SQL})")
_SUB_SQL = f"SELECT * FROM ({_ONCE_SQL}) UNION ALL SELECT * FROM ({_ONCE_SQL}) WHERE {Q.uniform(SEED, 'id', 'twice')} < 0.02"


@register("submission_violations",
          f"SELECT id, 'label_domain' AS violation FROM ({_SUB_SQL}) WHERE label NOT IN ('authentic', 'manipulated') "
          f"UNION ALL SELECT id, 'confidence_range' FROM ({_SUB_SQL}) WHERE NOT (confidence BETWEEN 0 AND 1) "
          f"UNION ALL SELECT id, 'type_domain' FROM ({_SUB_SQL}) WHERE manipulation_type NOT IN ('origin', 'text_swap', 'text_attribute') "
          f"UNION ALL SELECT id, 'authentic_type' FROM ({_SUB_SQL}) WHERE label = 'authentic' AND manipulation_type <> 'origin' "
          f"UNION ALL SELECT id, 'authentic_tokens' FROM ({_SUB_SQL}) WHERE label = 'authentic' AND len(tokens) > 0 "
          f"UNION ALL SELECT id, 'token_range' FROM ({_SUB_SQL}) WHERE len(list_filter(tokens, lambda t: t < 0 OR t >= n_tok)) > 0 "
          f"UNION ALL SELECT id, 'duplicate_id' FROM ({_SUB_SQL}) GROUP BY id HAVING count(*) > 1")
def q_submission_violations(spark, sf_dir):
    """One row per (id, violated rule) of a submission with injected
    errors; ids appearing more than once are found by aggregation (missing
    and unknown ids: ``submission_coverage``)."""
    d = v_eval(spark, sf_dir)
    idc = F.col("id")
    sub = d.select("id", "n_tok",
                   F.when(uniform(SEED, idc, "badlab") < 0.02, F.lit("Manipulated")).otherwise(F.col("pred_label")).alias("label"),
                   F.when(uniform(SEED, idc, "badconf") < 0.02, F.col("confidence") + 1.0).otherwise(F.col("confidence")).alias("confidence"),
                   F.when(uniform(SEED, idc, "badtype") < 0.02, F.lit("text_swap")).otherwise(F.col("pred_type")).alias("manipulation_type"),
                   F.when(uniform(SEED, idc, "badtok") < 0.02, F.array_append("pred_tokens", F.col("n_tok")))
                   .otherwise(F.col("pred_tokens")).alias("tokens"))
    sub = sub.unionByName(sub.filter(uniform(SEED, idc, "twice") < 0.02))  # some rows are handed in twice
    rules = {
        "label_domain": ~F.col("label").isin(EV.NEG, EV.POS),
        "confidence_range": ~F.col("confidence").between(0, 1),
        "type_domain": ~F.col("manipulation_type").isin("origin", "text_swap", "text_attribute"),
        "authentic_type": (F.col("label") == EV.NEG) & (F.col("manipulation_type") != "origin"),
        "authentic_tokens": (F.col("label") == EV.NEG) & (F.size("tokens") > 0),
        "token_range": F.exists("tokens", lambda t: (t < 0) | (t >= F.col("n_tok"))),
    }
    arr = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    per_row = sub.select("id", F.explode(arr).alias("violation"))
    dup = (sub.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
           .select("id", F.lit("duplicate_id").alias("violation")))
    return per_row.unionByName(dup)


@register("plausibility_prompt",
          "SELECT doc_id AS id, md5('Is this caption plausible for image ' || cast(doc_id AS VARCHAR) || '? Caption: ' || text) "
          "AS prompt_md5 FROM documents")
def q_plausibility_prompt(spark, sf_dir):
    """Prompt text per image-caption pair (for a later model job)."""
    d = table(spark, sf_dir, "documents")
    p = F.concat(F.lit("Is this caption plausible for image "), F.col("doc_id").cast("string"), F.lit("? Caption: "), F.col("text"))
    return d.select(F.col("doc_id").alias("id"), F.md5(p).alias("prompt_md5"))
