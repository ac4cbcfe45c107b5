"""Registered queries: streaming accept / resume / dedup (M1-M3) and file
round trips for sources and sinks (A1, A2, A3, A5, A6, A9, A10, B1-B4, B7, P6).

Round trips write data derived from the given tables into a fresh scratch
folder, then read it back with the source under test.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import vocab as V
from ..operators import captions as CAP
from ..sources import readers as RD
from ..sources import sinks as SK
from ..session import cut_lineage, scratch_dir
from ..streaming import incremental as INC
from .pipeline import all_records, goals_of, records_as_text
from .queries_core import ALL_RECORDS_SQL, FLAGSHIP_SQL
from .registry import register
from .views import SEED, table, v_job


def _candidates(spark, sf_dir):
    return CAP.with_captions(v_job(spark, sf_dir), SEED).select(
        "id", "accept_order", "bucket", "text", "fake_text_pos", "fake_cls")


def _records(df):
    return records_as_text(SK.make_records(df.withColumn("image", SK.image_path(F.col("bucket"), F.col("id"), SEED))))


@register("stream_accept", FLAGSHIP_SQL)
def q_stream_accept(spark, sf_dir):
    """M1: the accept loop as a file stream; equals the batch flagship."""
    work = scratch_dir(spark, "accept")
    src = os.path.join(work, "src")
    c = _candidates(spark, sf_dir)
    files = INC.stage_in_order(c, src, "accept_order", 4)
    INC.run_accept(spark, src, c.schema, work, goals_of(INC.staged(spark, src)), files=files)
    return _records(INC.accepted(spark, work))


@register("stream_resume", FLAGSHIP_SQL)
def q_stream_resume(spark, sf_dir):
    """M3: run on the first three chunks, stop, add the last chunk, restart
    from the checkpoint, then restart once more with nothing new (adds 0)."""
    work = scratch_dir(spark, "resume")
    src = os.path.join(work, "src")
    c = _candidates(spark, sf_dir)
    files = INC.stage_in_order(c, src, "accept_order", 4, only=range(3))
    goals = goals_of(INC.staged(spark, src))
    INC.run_accept(spark, src, c.schema, work, goals, files=files)
    INC.stage_in_order(c, src, "accept_order", 4, only=[3])
    INC.run_accept(spark, src, c.schema, work, goals, files=files)
    before = INC.accepted(spark, work).count()
    INC.run_accept(spark, src, c.schema, work, goals, files=files)
    if INC.accepted(spark, work).count() != before:
        raise AssertionError("a resumed run with no new input added rows")
    return _records(INC.accepted(spark, work))


@register("snapshot_at",
          f"WITH r AS ({FLAGSHIP_SQL}), a AS (SELECT id, row_number() OVER (ORDER BY id) AS arrival FROM r) "
          f"SELECT arrival // {V.SNAP_EVERY} AS version, arrival AS rows, cast(total AS BIGINT) AS total FROM (SELECT arrival, sum(id) OVER (ORDER BY arrival) AS total FROM a) WHERE arrival % {V.SNAP_EVERY} = 0")
def q_snapshot_at(spark, sf_dir):
    """M4 / H5: every snapshot that a run of the accept loop logged, with its rows and the sum of
    their ids, read back by arrival ranges."""
    work = scratch_dir(spark, "snapshots")
    src = os.path.join(work, "src")
    c = _candidates(spark, sf_dir)
    files = INC.stage_in_order(c, src, "accept_order", 4)
    INC.run_accept(spark, src, c.schema, work, goals_of(INC.staged(spark, src)), files=files)
    return INC.snapshot_totals(spark, work, "id")


@register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark, sf_dir):
    """M2: streaming exact dedup on (user_id, event_type) over events files."""
    work = scratch_dir(spark, "sdedup")
    src = os.path.join(work, "src")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    files = INC.stage_in_order(ev, src, "event_id", 4)
    return INC.stream_dedup(spark, src, ev.schema, ["user_id", "event_type"], work, files).select("user_id", "event_type")


# ---- sources / sinks round trips -------------------------------------------

_CITY_SQL = ("SELECT name, min(pos) AS first_pos FROM (SELECT trim(coalesce(nullif(city_ascii, ''), nullif(city, ''), nullif(nm, ''))) AS name, "
             "row_number() OVER (ORDER BY pos) AS pos FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN '' ELSE n_name END AS city_ascii, "
             "' ' || c_name || ' ' AS city, c_mktsegment AS nm, c_custkey AS pos FROM customer JOIN nation ON c_nationkey = n_nationkey) "
             "WHERE coalesce(nullif(city_ascii, ''), nullif(city, ''), nullif(nm, '')) IS NOT NULL) GROUP BY name")


def _city_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("n_name")).alias("city_ascii"),
                    F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("city"), F.col("c_mktsegment").alias("name"),
                    F.col("c_custkey")).repartitionByRange("c_custkey").sortWithinPartitions("c_custkey").drop("c_custkey"))


@register("scan_city_csv", _CITY_SQL)
def q_scan_city_csv(spark, sf_dir):
    """A1 + I1 + J1: CSV gazetteer, first non-empty name column, limit in
    file order before an order-preserving distinct."""
    path = os.path.join(scratch_dir(spark, "city"), "cities.csv")
    _city_rows(spark, sf_dir).write.option("header", True).csv(path)
    return RD.city_names_csv(spark, path).select("name", "first_pos")


@register("scan_city_tsv",
          "SELECT name, min(pos) AS first_pos FROM (SELECT trim(c_name) AS name, row_number() OVER (ORDER BY c_custkey) AS pos "
          "FROM customer) GROUP BY name")
def q_scan_city_tsv(spark, sf_dir):
    """A2: headerless TSV, name in field 1 (quoting off)."""
    path = os.path.join(scratch_dir(spark, "tsv"), "cities.txt")
    c = table(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    c.select(F.concat_ws("\t", F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")).alias("value")) \
        .write.text(path)
    return RD.city_names_tsv(spark, path).select("name", "first_pos")


@register("source_fallback",
          "SELECT name, min(pos) AS first_pos FROM (SELECT trim(c_name) AS name, row_number() OVER (ORDER BY c_custkey) AS pos "
          "FROM customer) GROUP BY name")
def q_source_fallback(spark, sf_dir):
    """A3: explicit path missing, CSV present but empty -> the TSV wins."""
    d = scratch_dir(spark, "fallback")
    csv = os.path.join(d, "cities.csv")
    spark.createDataFrame([], "city string").write.option("header", True).csv(csv)
    tsv = os.path.join(d, "cities.txt")
    c = table(spark, sf_dir, "customer").repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    c.select(F.concat_ws("\t", F.col("c_custkey").cast("string"), F.col("c_name")).alias("value")).write.text(tsv)
    return RD.datelines(spark, [os.path.join(d, "missing.csv"), csv, tsv]).select("name", "first_pos")


_REC_SQL = f"SELECT * FROM ({ALL_RECORDS_SQL})"


@register("sink_append", _REC_SQL)
def q_sink_append(spark, sf_dir):
    """B1 + A5: records appended as JSON lines in two runs, read back FAILFAST."""
    path = os.path.join(scratch_dir(spark, "jsonl"), "metadata.jsonl")
    rec = cut_lineage(all_records(spark, sf_dir))  # written in two runs, made once
    SK.append_jsonl(rec.filter(F.col("id") % 2 == 0), path)
    SK.append_jsonl(rec.filter(F.col("id") % 2 == 1), path)
    return records_as_text(RD.read_jsonl(spark, path))


@register("sink_snapshot", _REC_SQL)
def q_sink_snapshot(spark, sf_dir):
    """B2 + A6: versioned full snapshot, overwritten, read back."""
    base = scratch_dir(spark, "snap")
    rec = cut_lineage(all_records(spark, sf_dir))  # written twice, made once
    SK.write_snapshot(rec.filter("fake_cls = 'origin'"), base, version=1)
    out = SK.write_snapshot(rec, base, version=1)
    return records_as_text(RD.read_snapshot(spark, out))


@register("sink_partitioned",
          "SELECT fake_cls, count(*) AS n FROM (" + ALL_RECORDS_SQL + ") GROUP BY fake_cls")
def q_sink_partitioned(spark, sf_dir):
    """One directory per class; counts read back with partition pruning."""
    path = os.path.join(scratch_dir(spark, "part"), "records")
    SK.write_partitioned(all_records(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("fake_cls").agg(F.count(F.lit(1)).alias("n"))


@register("build_records", f"SELECT id, image, fake_image_box, fake_text_pos, mtcnn_boxes FROM ({ALL_RECORDS_SQL})")
def q_build_records(spark, sf_dir):
    """Record constructor with empty-list defaults."""
    return records_as_text(all_records(spark, sf_dir)).select("id", "image", "fake_image_box", "fake_text_pos", "mtcnn_boxes")
