"""End-to-end plans built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import resolve_seed
from ..functions.text import ints_to_str
from ..operators.captions import with_captions
from ..operators.dedup import first_wins
from ..operators.quota import quota_fill
from ..session import cut_lineage
from ..sources.sinks import image_path, make_records
from .views import SEED, v_job

GOAL_SHARE = {"lit": 0.5, "inv": 0.4, "irr": 0.4}  # of a class's jobs: quotas grow with the input


def goals_of(jobs: DataFrame, share: dict[str, float] = GOAL_SHARE) -> dict[str, int]:
    """Quota per class, a share of its jobs (one number per class is read)."""
    n = {r.bucket: r.n for r in jobs.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    return {b: int(n.get(b, 0) * s) for b, s in share.items()}


def caption_records(spark: SparkSession, sf_dir: str, seed=SEED, goals=None,
                    span_mode: str = "exact", vocab=V) -> DataFrame:
    """Flagship: caption jobs -> tags -> captions + spans -> first-wins caption
    dedup -> per-class quota in arrival order -> sample records.
    ``goals=None`` takes GOAL_SHARE of each class's jobs; ``seed=None`` picks a random seed for the run;
    ``vocab`` replaces the word lists (``vocab.with_lists``)."""
    seed = resolve_seed(seed)
    jobs = v_job(spark, sf_dir, seed, vocab=vocab)
    caps = cut_lineage(_captions(jobs, seed, span_mode, vocab))  # the quota reads its keys before its rows
    filled = quota_fill(caps, goals or goals_of(jobs))
    return make_records(filled.withColumn("image", image_path(F.col("bucket"), F.col("id"), seed)))


def all_records(spark: SparkSession, sf_dir: str, seed=SEED) -> DataFrame:
    """The records of every distinct caption, without a quota."""
    caps = _captions(v_job(spark, sf_dir, seed), seed)
    return make_records(caps.withColumn("image", image_path(F.col("bucket"), F.col("id"), seed)))


def _captions(jobs: DataFrame, seed, span_mode: str = "exact", vocab=V) -> DataFrame:
    caps = with_captions(jobs, seed, span_mode, vocab=vocab).select(
        "id", "accept_order", "bucket", "text", "fake_text_pos", "fake_cls")
    return first_wins(caps, ["text"])


def records_as_text(df: DataFrame) -> DataFrame:
    """Array columns as comma / semicolon strings (engine-neutral compare)."""
    out = df
    for c in ("fake_image_box", "fake_text_pos"):
        if c in df.columns:
            out = out.withColumn(c, ints_to_str(F.col(c)))
    if "mtcnn_boxes" in df.columns:
        out = out.withColumn("mtcnn_boxes", F.array_join(F.transform("mtcnn_boxes", lambda b: ints_to_str(b)), ";"))
    return out
