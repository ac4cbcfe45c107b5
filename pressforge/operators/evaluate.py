"""Submission scoring and release checks.

Every metric is one aggregation over the joined gold/prediction rows: a few
conditional sums, combined into one-row results. ROC-AUC uses score groups
and an exact running sum over distinct scores instead of a global rank window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import uniform
from ..plans.ranking import ordered_running_sum

POS = "manipulated"
NEG = "authentic"
TYPES = ["text_swap", "text_attribute"]


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    d = F.lit(2.0) * tp + fp + fn
    return F.when(d > 0, F.lit(2.0) * tp / d).otherwise(F.lit(0.0))


def authenticity_label(fake_cls: Column) -> Column:
    """Origin -> authentic, anything else -> manipulated."""
    return F.when(fake_cls == "origin", F.lit(NEG)).otherwise(F.lit(POS))


def accuracy(df: DataFrame, gold: str = "gold_label", pred: str = "pred_label") -> DataFrame:
    """G10."""
    return df.agg(F.avg((F.col(gold) == F.col(pred)).cast("double")).alias("accuracy"))


def binary_counts(df: DataFrame, gold: str = "gold_label", pred: str = "pred_label") -> DataFrame:
    g, p = F.col(gold) == POS, F.col(pred) == POS
    return df.agg(F.sum((g & p).cast("bigint")).alias("tp"), F.sum((~g & p).cast("bigint")).alias("fp"),
                  F.sum((g & ~p).cast("bigint")).alias("fn"))


def f1_binary(df: DataFrame, gold: str = "gold_label", pred: str = "pred_label") -> DataFrame:
    """Positive class = manipulated; 0 when there is nothing to score."""
    c = binary_counts(df, gold, pred)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select("tp", "fp", "fn",
                    F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
                    F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
                    _f1(tp, fp, fn).alias("f1_binary"))


SCORE_BITS = 37  # blocks of 2^-16 of the score range


def score_key(score: Column) -> Column:
    """Integer image of a score in [0, 1] that never reverses two scores (closer ones may share it)."""
    return (score * F.lit(float(2 ** 53))).cast("bigint")


def roc_auc(df: DataFrame, gold: str = "gold_label", score: str = "confidence") -> DataFrame:
    """Mann-Whitney AUC with tie-averaged ranks.

    Rows are folded into (score, positives, negatives) groups by the score itself;
    negatives below each score come from an exact block-split running sum."""
    g = df.groupBy(F.col(score).alias("_score")).agg(
        F.sum((F.col(gold) == POS).cast("bigint")).alias("p"), F.sum((F.col(gold) != POS).cast("bigint")).alias("n"))
    g = g.withColumn("_key", score_key(F.col("_score")))
    c = ordered_running_sum(g, "n", "_key", None, out="_ncum", bits=SCORE_BITS, tiebreak=["_score"])
    c = c.withColumn("_nb", F.col("_ncum") - F.col("n"))
    return c.agg((F.sum(F.col("p") * (F.col("_nb") + F.lit(0.5) * F.col("n"))) /
                  (F.sum("p") * F.sum("n"))).alias("auc"))


def type_scores(df: DataFrame, gold: str = "gold_type", pred: str = "pred_type", gold_label: str = "gold_label") -> DataFrame:
    """Type accuracy and macro F1 over {text_swap, text_attribute},
    gold-manipulated rows only."""
    d = df.filter(F.col(gold_label) == POS)
    aggs = [F.avg((F.col(gold) == F.col(pred)).cast("double")).alias("type_accuracy")]
    for t in TYPES:
        g, p = F.col(gold) == t, F.col(pred) == t
        aggs += [F.sum((g & p).cast("bigint")).alias(f"tp_{t}"), F.sum((~g & p).cast("bigint")).alias(f"fp_{t}"),
                 F.sum((g & ~p).cast("bigint")).alias(f"fn_{t}")]
    a = d.agg(*aggs)
    f1s = [_f1(F.col(f"tp_{t}"), F.col(f"fp_{t}"), F.col(f"fn_{t}")) for t in TYPES]
    return a.select(F.coalesce("type_accuracy", F.lit(0.0)).alias("type_accuracy"),
                    (sum(f1s[1:], f1s[0]) / F.lit(float(len(TYPES)))).alias("f1_type"))


def token_scores(df: DataFrame, gold: str = "gold_tokens", pred: str = "pred_tokens",
                 gold_label: str = "gold_label") -> DataFrame:
    """Token grounding on gold-manipulated rows: micro P/R/F1 and the
    mean per-sample F1 (1.0 when both sets are empty)."""
    d = df.filter(F.col(gold_label) == POS).select(
        F.size(F.array_intersect(gold, pred)).alias("i"), F.size(gold).alias("g"), F.size(pred).alias("p"))
    per = F.when(F.col("g") + F.col("p") == 0, F.lit(1.0)).otherwise(F.lit(2.0) * F.col("i") / (F.col("g") + F.col("p")))
    a = d.agg(F.sum("i").alias("ti"), F.sum("g").alias("tg"), F.sum("p").alias("tp"), F.avg(per).alias("macro_f1"))
    ti, tg, tp = F.col("ti"), F.col("tg"), F.col("tp")
    prec = F.when(tp > 0, ti / tp).otherwise(F.lit(0.0))
    rec = F.when(tg > 0, ti / tg).otherwise(F.lit(0.0))
    return a.select(prec.alias("token_precision"), rec.alias("token_recall"),
                    F.when(tp + tg > 0, F.lit(2.0) * ti / (tp + tg)).otherwise(F.lit(0.0)).alias("f1_text"),
                    F.coalesce("macro_f1", F.lit(0.0)).alias("token_macro_f1"))


def final_score(df: DataFrame, weights=V.SCORE_WEIGHTS, group: list[str] | None = None) -> DataFrame:
    """0.5 F1_binary + 0.3 F1_text + 0.2 F1_type, all from ONE pass of
    conditional sums (no joins between partial results)."""
    gm = F.col("gold_label") == POS
    pm = F.col("pred_label") == POS

    def cnt(c):
        return F.sum(c.cast("bigint"))
    aggs = [cnt(gm & pm).alias("tp"), cnt(~gm & pm).alias("fp"), cnt(gm & ~pm).alias("fn"),
            F.sum(F.when(gm, F.size(F.array_intersect("gold_tokens", "pred_tokens")))).alias("ti"),
            F.sum(F.when(gm, F.size("gold_tokens"))).alias("tg"),
            F.sum(F.when(gm, F.size("pred_tokens"))).alias("tq")]
    for t in TYPES:
        g, p = F.col("gold_type") == t, F.col("pred_type") == t
        aggs += [cnt(gm & g & p).alias(f"tp_{t}"), cnt(gm & ~g & p).alias(f"fp_{t}"), cnt(gm & g & ~p).alias(f"fn_{t}")]
    g = list(group or [])
    a = df.groupBy(*g).agg(*aggs) if g else df.agg(*aggs)
    ti, tg, tq = (F.coalesce(F.col(c), F.lit(0)) for c in ("ti", "tg", "tq"))
    f1_text = F.when(tq + tg > 0, F.lit(2.0) * ti / (tq + tg)).otherwise(F.lit(0.0))
    f1s = [_f1(F.col(f"tp_{t}"), F.col(f"fp_{t}"), F.col(f"fn_{t}")) for t in TYPES]
    f1_type = sum(f1s[1:], f1s[0]) / F.lit(float(len(TYPES)))
    wb, wt, wy = weights
    out = a.select(*g, _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1_binary"), f1_text.alias("f1_text"),
                   f1_type.alias("f1_type"))
    return out.withColumn("score", F.lit(wb) * F.col("f1_binary") + F.lit(wt) * F.col("f1_text") + F.lit(wy) * F.col("f1_type"))


def confusion(df: DataFrame, gold: str = "gold_label", pred: str = "pred_label") -> DataFrame:
    """Counts per gold class and predicted class."""
    return (df.groupBy(F.col(gold).alias("gold_label")).pivot(pred, [NEG, POS]).count()
            .na.fill(0, [NEG, POS]))


def split_assign(df: DataFrame, group_col: Column, seed, cuts=(0.8, 0.9)) -> Column:
    """Train / validation / test by a draw on the group key, so a whole
    duplicate group lands in one split."""
    u = uniform(seed, group_col, "split")
    return F.when(u < cuts[0], F.lit("train")).when(u < cuts[1], F.lit("validation")).otherwise(F.lit("test"))


def leaderboard(scores: DataFrame, team_col: str = "team", score_col: str = "score") -> DataFrame:
    """H8: rank teams by score (one row per team; a small table)."""
    return scores.withColumn("rank", F.rank().over(Window.orderBy(F.col(score_col).desc())))
