"""Atomic commit of records together with their files (J2, F10; survey T6, T7).

A run writes two things that must agree: the records and the files they name. Each attempt
stages both under its own name; one manifest, written last, makes the attempt visible. A
reader trusts manifests only, so an attempt that died in between leaves nothing that is
read: neither records without files nor files without records.

    <root>/records/run=<run>/attempt=<id>/...   staged records
    <root>/files/run=<run>/attempt=<id>/...     staged file table (path, bytes)
    <root>/manifests/run=<run>/...              attempt, record and file counts

A run is repeated under the same number until its manifest is there; repeating a committed
run does nothing. If two attempts of a run commit at the same time, both manifests are
there and the smaller attempt name counts, for every reader alike. ``audit`` lists what
uncommitted attempts have left (it may be removed at any time).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import path_exists

MANIFEST = "attempt string, records long, files long"


def _part(root: str, kind: str, run: int, attempt: str | None = None) -> str:
    p = os.path.join(root, kind, f"run={run}")
    return os.path.join(p, f"attempt={attempt}") if attempt else p


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """run, attempt, records, files of the committed runs."""
    p = os.path.join(root, "manifests")
    if not path_exists(spark, p):
        return spark.createDataFrame([], f"run long, {MANIFEST}")
    m = spark.read.schema(f"{MANIFEST}, run long").json(p)
    one = m.groupBy("run").agg(F.min(F.struct("attempt", "records", "files")).alias("m"))
    return one.select("run", "m.*")


def commit(records: DataFrame, files: DataFrame, root: str, run: int, attempt: str | None = None,
           between: Callable[[str], None] | None = None) -> bool:
    """Stages records (with a ``path`` column) and files (path, ...), checks that they name the same
    paths, and commits. False if the run was committed before. ``between`` is called after each
    step with its name (tests stop an attempt there)."""
    spark = records.sparkSession
    if manifests(spark, root).filter(F.col("run") == run).limit(1).count():
        return False
    attempt = attempt or uuid.uuid4().hex
    tell = between or (lambda step: None)
    rec_p, file_p = (_part(root, k, run, attempt) for k in ("records", "files"))
    files.write.mode("overwrite").parquet(file_p)
    tell("files")
    records.write.mode("overwrite").parquet(rec_p)
    tell("records")
    # what was staged is judged, not what would be computed again
    rec, fil = spark.read.parquet(rec_p).select("path"), spark.read.parquet(file_p).select("path")
    n, m = rec.count(), fil.count()
    a, b = rec.withColumn("r", F.lit(1)), fil.withColumn("f", F.lit(1))
    wrong = a.unionByName(b, allowMissingColumns=True).groupBy("path").agg(F.count("r").alias("r"), F.count("f").alias("f")).filter("r = 0 or f != 1")
    if wrong.limit(1).count():
        raise ValueError(f"run {run}: records and files name different paths")
    tell("checked")
    out = _part(root, "manifests", run)
    spark.createDataFrame([(attempt, n, m)], MANIFEST).coalesce(1).write.mode("append").json(out)
    tell("manifest")
    return True


def _read(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """The staged rows of the attempts that manifests name, by path: other attempts are not listed."""
    named = [_part(root, kind, r.run, r.attempt) for r in manifests(spark, root).orderBy("run").collect()]  # a row a run
    return spark.read.option("basePath", os.path.join(root, kind)).parquet(*named).drop("attempt") if named else None


def read_records(spark: SparkSession, root: str) -> DataFrame | None:
    """The committed records and their run; None if no run is committed."""
    return _read(spark, root, "records")


def read_files(spark: SparkSession, root: str) -> DataFrame | None:
    return _read(spark, root, "files")


def audit(spark: SparkSession, root: str) -> DataFrame:
    """kind, run, attempt, rows: what attempts have staged that no manifest names."""
    out = spark.createDataFrame([], "kind string, run long, attempt string, rows long")
    named = manifests(spark, root).select("run", "attempt")
    for kind in ("records", "files"):
        p = os.path.join(root, kind)
        if path_exists(spark, p):
            staged = spark.read.parquet(p).groupBy(F.col("run").cast("long").alias("run"), "attempt").agg(F.count(F.lit(1)).alias("rows"))
            out = out.unionByName(staged.join(named, ["run", "attempt"], "left_anti").select(F.lit(kind).alias("kind"), "run", "attempt", "rows"))
    return out
