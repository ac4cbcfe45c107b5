"""Mergeable distinct counts (G7): HyperLogLog sketches per run, united across runs.

An exact distinct count over all runs reads every caption again. A sketch of fixed size per
run and group is stored with the run; a later run unites the stored sketches with its own,
and never reads earlier captions. The relative standard error of an estimate is about
1.04 / sqrt(2^lg_k), whatever the count; ``BOUND`` is five times that.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import path_exists

LG_K = 14
BOUND = 5 * 1.04 / 2 ** (LG_K / 2)  # 4.1 %


def sketch(df: DataFrame, group: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """group, rows, sketch. The value's 128-bit digest is counted, so texts aren't shuffled: tasks
    send sketches only. Null values aren't counted."""
    return df.groupBy(*group).agg(F.count(value).alias("rows"), F.hll_sketch_agg(F.md5(F.col(value).cast("binary")), F.lit(lg_k)).alias("sketch"))


def store(df: DataFrame, path: str, run: int) -> None:
    """Writes a run's sketches; a repeated run overwrites its own."""
    df.write.mode("overwrite").parquet(os.path.join(path, f"run={run}"))


def united(spark: SparkSession, path: str, group: list[str]) -> DataFrame:
    """group, rows, n_distinct over all stored runs, from their sketches alone."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    d = spark.read.parquet(path)
    u = d.groupBy(*group).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch", True).alias("sketch")) if group else d.agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("sketch", True).alias("sketch"))
    return u.select(*group, "rows", F.hll_sketch_estimate("sketch").alias("n_distinct"))


def within(estimate, exact, bound: float = BOUND):
    """Is the estimate within the stated bound of the exact count?"""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(bound))
