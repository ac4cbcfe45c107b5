"""Registered queries: runs that are committed whole (J2, F10) and counted by sketches."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import sketch as SK
from ..session import scratch_dir
from ..sources import commit as C
from ..sources.sinks import image_path
from .queries_quota import JOBS_SQL, _IMG_SQL, _jobs_status
from .registry import register
from .views import SEED, table

RUNS = 3
_RUN_SQL = f"CASE WHEN is_old THEN 0 ELSE 1 + id % {RUNS - 1} END"


class Stopped(RuntimeError):
    """An attempt that is ended on purpose."""


@register("commit_read", f"SELECT id, bucket, {_IMG_SQL} AS path, cast({_RUN_SQL} AS BIGINT) AS run FROM ({JOBS_SQL})")
def q_commit_read(spark, sf_dir):
    """J2 + F10: the stored records and two later runs, each committed with its files. An attempt
    of every later run dies at another step before it is repeated; none of it is read."""
    root = scratch_dir(spark, "commit")
    j = _jobs_status(spark, sf_dir).withColumn("run", F.when(F.col("is_old"), 0).otherwise(F.col("id") % (RUNS - 1) + 1).cast("long"))
    rec = j.select("id", "bucket", image_path(F.col("bucket"), F.col("id"), SEED).alias("path"), "run")

    def die_at(step):
        def stop(now):
            if now == step:
                raise Stopped(step)
        return stop

    for run, step in zip(range(RUNS), (None, "files", "checked")):
        mine = rec.filter(F.col("run") == run).drop("run")
        files = mine.select("path", (F.length("path") * 1000).alias("bytes"))
        if step:
            try:
                C.commit(mine, files, root, run, between=die_at(step))
            except Stopped:
                pass
        C.commit(mine, files, root, run)
    found = C.read_records(spark, root).select("id", "bucket", "path", F.col("run").cast("long").alias("run"))
    return found.join(C.read_files(spark, root).select("path"), "path", "left_semi").select("id", "bucket", "path", "run")


@register("distinct_sketch",
          "SELECT lang, count(text) AS rows, count(DISTINCT text) AS n_distinct, true AS within_bound FROM documents GROUP BY lang "
          "UNION ALL SELECT '(all)', count(text), count(DISTINCT text), true FROM documents")
def q_distinct_sketch(spark, sf_dir):
    """Distinct texts per language and in all, from sketches that three runs stored, beside the
    exact count: is every estimate within the stated bound?"""
    path = os.path.join(scratch_dir(spark, "sketches"), "captions")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    for run in range(RUNS):
        SK.store(SK.sketch(d.filter(F.pmod(F.xxhash64("doc_id"), F.lit(RUNS)) == run), ["lang"], "text"), path, run)
    est = SK.united(spark, path, ["lang"]).unionByName(SK.united(spark, path, []).withColumn("lang", F.lit("(all)")))
    one = d.groupBy("lang").agg(F.count_distinct(F.md5("text")).alias("exact"))
    exact = one.unionByName(d.agg(F.count_distinct(F.md5("text")).alias("exact")).select(F.lit("(all)").alias("lang"), "exact"))
    j = est.join(exact, est["lang"].eqNullSafe(exact["lang"])).select(est["lang"], "rows", "exact", "n_distinct")
    return j.select("lang", "rows", F.col("exact").alias("n_distinct"), SK.within(F.col("n_distinct"), F.col("exact")).alias("within_bound"))
