"""Incremental accept loop with resume (M1-M4) on Structured Streaming.

Candidates arrive as files, in arrival order. Each micro-batch:
  1. the caller's gates, if any (faces, text), on the batch's own rows;
  2. joint first-wins dedup: a row goes if a row kept before it, in this batch or an
     earlier one, has the same caption or (with ``hash_col``) a near image;
  3. per-class quota against the rows accepted by earlier batches;
  4. writes what it kept to the key indexes, the accepted rows with their arrival numbers
     to ``accepted/batch=<id>``, and its running totals to ``state/batch=<id>``, all with
     overwrite, so a replayed batch (after a failure) rewrites the same files.

Of earlier batches it reads the state of the last one (one row) and, from the key indexes,
the folders of the captions and image bands it asks for (see ``keyindex``). What a batch
costs doesn't grow with the history.

The checkpoint makes a restart continue where it stopped (resume); a run with no new files
adds nothing. Results equal the batch plan when files arrive in arrival order.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..operators.dedup import first_wins, greedy_keep
from ..operators.neardup import BANDS, band_keys, hamming, near_pairs, neighbour_edges
from ..operators.quota import quota_fill
from ..plans.ranking import DENSE_BITS, ordered_rank, ordered_running_sum
from ..sources.readers import path_exists, remove
from .keyindex import TARGET, KeyIndex, State

FILES = 4  # least files of a chunk, and of a micro-batch
ROWS_A_FILE = 50_000  # so that the tasks of a batch follow its rows
_INDEX = "struct<gen:long,bits:long,pairs:long,bytes_read:long>"
STATE = f"counts map<string,long>, total long, text {_INDEX}, image {_INDEX}"


def digest(df: DataFrame) -> DataFrame:
    """128 bits of a caption: what the loop remembers of it."""
    return df.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("caption"), F.col("text"))})


def _stage(src: str) -> str:
    return os.path.join(os.path.dirname(src.rstrip("/")), "_staged_" + os.path.basename(src.rstrip("/")))


def staged(spark: SparkSession, src: str) -> DataFrame:
    """All candidates that were staged for ``src``."""
    return spark.read.parquet(_stage(src)).drop("chunk_no")


def stage_in_order(df: DataFrame, src: str, order_col: str, chunks: int, only=None, files: int | None = None) -> int:
    """Write candidates as ``chunks`` groups of ``files`` files by arrival range, one
    group after another, so that a micro-batch of ``files`` files is one range.
    Returns ``files``: by default as many as ROWS_A_FILE asks for, FILES at least; never more
    than the rows of a chunk, and an empty chunk is left out, as files without rows aren't
    written and later batches would straddle ranges.

    The candidates are computed once into a staging table, a folder per chunk, so that a chunk
    reads its own rows only."""
    spark, stage = df.sparkSession, _stage(src)
    if not path_exists(spark, stage):
        lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
        width = max(1, (int(hi) - int(lo)) // chunks + 1)
        c = ((F.col(order_col) - F.lit(int(lo))) / F.lit(width)).cast("int")
        df.withColumn("chunk_no", c).write.mode("overwrite").partitionBy("chunk_no").parquet(stage)
    st = spark.read.parquet(stage)
    rows = {r.chunk_no: r.n for r in st.groupBy("chunk_no").agg(F.count(F.lit(1)).alias("n")).filter("chunk_no is not null").collect()}  # a row a chunk
    files = min(files or max(FILES, -(-sum(rows.values()) // (chunks * ROWS_A_FILE))), *rows.values())
    for i in (only if only is not None else range(chunks)):
        if i in rows:
            st.filter(F.col("chunk_no") == i).drop("chunk_no").repartition(files).write.mode("overwrite").parquet(os.path.join(src, f"chunk={i:06d}"))
    return files


def _state_before(spark: SparkSession, path: str, batch_id: int) -> dict:
    if batch_id == 0:
        return {"counts": {}, "total": 0, "text": State(), "image": State()}
    r = spark.read.schema(STATE).parquet(os.path.join(path, f"batch={batch_id - 1}")).first().asDict(recursive=True)
    return r | {k: State(**r[k]) for k in ("text", "image")}


def run_accept(spark: SparkSession, src: str, schema, work: str, goals: dict[str, int],
               order_col: str = "accept_order", snap_every: int = V.SNAP_EVERY, files: int = FILES,
               gates: Callable[[DataFrame], DataFrame] | None = None, hash_col: str | None = None,
               max_distance: int = V.PHASH_DISTANCE_MAX, target: int = TARGET) -> None:
    """One availableNow run of the accept loop over the files now in ``src``.

    ``gates`` maps the rows of a batch to those that pass; ``hash_col`` names the image
    fingerprint for the near-image gate (null: unreadable, near nothing); ``target`` is the
    size of an index folder.

    M4: accepted rows carry their arrival number, and for every multiple of ``snap_every``
    that a batch crosses it logs the version with its range of arrivals, instead of
    rewriting all records (which would cost O(n^2 / snap_every) bytes over a run);
    ``snapshot(version)`` reads the rows up to that arrival. Work folders may be on any file
    system that Spark reads."""
    acc_p, state_p, snap_p, ck = (os.path.join(work, x) for x in ("accepted", "state", "snapshots", "checkpoint"))

    def batch(df: DataFrame, batch_id: int) -> None:
        s = df.sparkSession
        before = _state_before(s, state_p, batch_id)
        texts, images = (KeyIndex(s, os.path.join(work, "seen", n), target) for n in ("text", "image"))
        # used several times below; kept for the batch only (a lost executor's blocks are
        # recomputed from the batch's own files)
        cand = digest(gates(df) if gates else df).persist()
        at = texts.open(before["text"], batch_id)
        old, at = texts.lookup(cand.select(F.col("t1").alias("k")), at, batch_id)
        fresh = cand.join(old.toDF("t1", "t2"), ["t1", "t2"], "left_anti")
        near = before["image"]
        if hash_col:
            near = images.open(near, batch_id)
            asked = band_keys(fresh, hash_col, max_distance, BANDS).persist()
            kept_before, near = images.lookup(asked, near, batch_id)
            hit = asked.join(kept_before.withColumnRenamed("v", "_v"), "k").filter(hamming(F.col("h"), F.col("_v")) <= max_distance)
            fresh = fresh.join(hit.select(F.col("h").alias(hash_col)).distinct(), hash_col, "left_anti").persist()
            edges = neighbour_edges(near_pairs(fresh, col=hash_col, k=max_distance))
            kept = greedy_keep(fresh, order_col, [(hash_col, edges), ("text", None)]).filter("kept").drop("kept").persist()
            near = images.add(band_keys(kept, hash_col, max_distance, BANDS).select("k", F.col("h").alias("v")), near, batch_id)
        else:
            kept = first_wins(fresh, ["text"], order_col).persist()
        at = texts.add(kept.select(F.col("t1").alias("k"), F.col("t2").alias("v")), at, batch_id)
        have = before["counts"]
        left = {b: max(0, g - int(have.get(b, 0))) for b, g in goals.items()}
        out = quota_fill(kept.drop("t1", "t2"), left, order_col)
        out = ordered_rank(out, order_col, None, out="arrival", bits=DENSE_BITS).withColumn("arrival", F.col("arrival") + before["total"])
        out_p = os.path.join(acc_p, f"batch={batch_id}")
        out.write.mode("overwrite").parquet(out_p)
        new = {r["bucket"]: r["n"] for r in s.read.schema(out.schema).parquet(out_p).groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        total = before["total"] + sum(new.values())
        versions = range(before["total"] // snap_every + 1, total // snap_every + 1)
        if versions:
            v = F.col("version")
            s.range(versions.start, versions.stop).select(
                F.col("id").alias("version"), F.lit(batch_id).cast("long").alias("upto_batch"), (F.col("id") * snap_every).alias("rows")).select(
                v, "upto_batch", "rows", ((v - 1) * snap_every + 1).alias("first_arrival"), F.col("rows").alias("last_arrival")
            ).coalesce(1).write.mode("overwrite").json(os.path.join(snap_p, f"batch={batch_id}"))
        counts = {b: int(have.get(b, 0)) + int(new.get(b, 0)) for b in {*have, *new}}
        as_row = [(counts, total, tuple(vars(at).values()), tuple(vars(near).values()))]
        s.createDataFrame(as_row, STATE).coalesce(1).write.mode("overwrite").parquet(os.path.join(state_p, f"batch={batch_id}"))  # last: the batch is done
        for used in (cand, kept, *((asked, fresh) if hash_col else ())):
            used.unpersist()

    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
              .option("recursiveFileLookup", "true").parquet(src))
    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def accept_arriving(spark: SparkSession, arriving: Iterable[DataFrame], work: str, goals: dict[str, int], **how) -> None:
    """The accept loop over candidates that arrive chunk by chunk, in order (``how``: see ``run_accept``).

    A chunk is made when the one before it is done, written as files, taken by the loop as one
    micro-batch and removed once the batch is committed, when nothing can ask for it again. So the
    disk holds the candidates and shuffles of one chunk, whatever arrives; what stays is what the
    loop remembers. A chunk without rows is passed over."""
    src = os.path.join(work, "src")
    for i, chunk in enumerate(arriving):
        at = os.path.join(src, f"chunk={i:06d}")
        with settings(spark, FREED):
            chunk.write.mode("overwrite").parquet(at)
            if spark.read.schema(chunk.schema).parquet(at).count():  # from the file footers
                run_accept(spark, src, chunk.schema, work, goals, files=ALL, **how)
        remove(spark, at)
        free(spark)


def versions(spark: SparkSession, work: str) -> DataFrame:
    """The log: version, upto_batch, rows, first_arrival, last_arrival of every snapshot."""
    return spark.read.schema("version long, upto_batch long, rows long, first_arrival long, last_arrival long").json(os.path.join(work, "snapshots"))


def snapshot(spark: SparkSession, work: str, version: int | None = None) -> DataFrame:
    """Rows of snapshot ``version``: the first ``rows`` arrivals of its log entry, wherever the
    batch borders lie. None: what the run had accepted when it finished (M4)."""
    if version is None:
        return accepted(spark, work)
    r = versions(spark, work).filter(F.col("version") == version).first()
    if r is None:
        raise ValueError(f"no snapshot {version}")
    d = spark.read.parquet(os.path.join(work, "accepted"))
    return d.filter((F.col("batch") <= r.upto_batch) & (F.col("arrival") <= r.last_arrival)).drop("batch", "arrival")


def snapshot_totals(spark: SparkSession, work: str, value_col: str) -> DataFrame:
    """version, rows, total: for every snapshot, its rows and the sum of a column over them, in one
    pass over the accepted rows: sums by version's own range, then a running sum over versions."""
    log = versions(spark, work)
    rows = spark.read.parquet(os.path.join(work, "accepted"))
    every = log.filter("version = 1").select(F.col("rows").alias("every"))  # one row
    own = rows.join(F.broadcast(every)).withColumn("version", F.ceil(F.col("arrival") / F.col("every"))).groupBy("version").agg(
        F.sum(value_col).alias("_s"), F.count(F.lit(1)).alias("_n"))
    run = ordered_running_sum(ordered_running_sum(own, "_s", "version", out="total", bits=DENSE_BITS), "_n", "version", out="rows", bits=DENSE_BITS)
    return log.select("version").join(run, "version").select("version", "rows", "total")


def accepted(spark: SparkSession, work: str) -> DataFrame:
    return spark.read.parquet(os.path.join(work, "accepted")).drop("batch", "arrival")


ALL = 2 ** 31 - 1  # files of a micro-batch: every one that is there

#: Shuffle files go when the query that wrote them is done, not when the driver collects its garbage.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def free(spark: SparkSession) -> None:
    """Lets Spark drop the shuffles, checkpoints and broadcasts that nothing refers to any more: it does so
    when the driver's garbage is collected, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: State on the executors' disks with a memory-bounded cache; a batch uploads the changes it made,
#: not the whole state. The query keeps these settings in its checkpoint.
BOUNDED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "512",
}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings for as long as a query is started and runs; then what was there before."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_dedup(spark: SparkSession, src: str, schema, keys: list[str], work: str, files: int = FILES) -> DataFrame:
    """M2: unbounded exact dedup state (no watermark): each key once.

    The set of keys grows for ever, so it isn't kept on the heap: the state store holds it on
    disk (about the key's bytes plus 50 an entry) behind a cache of fixed size."""
    out, ck = os.path.join(work, "out"), os.path.join(work, "checkpoint")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
              .option("recursiveFileLookup", "true").parquet(src))
    with settings(spark, BOUNDED_STATE):
        q = (stream.dropDuplicates(keys).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out)
