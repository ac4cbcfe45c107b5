"""Input views derived from the given tables (Spark side).

Every view reads whole tables; all per-row choices are seeded draws keyed on
the row's own key, so the same rows come out in any partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as T
from ..functions.sampling import Prefix, choice, draw_prefix, uniform, weighted_choice_col
from ..session import ensure_parallel

SEED = 7
JOB_ABSURD_RATE = 0.7


# Key column of each large table: a single-file scan of it is spread over the
# cores by this key (a no-op when the scan already has enough partitions).
# Dimension tables (customer, part, labels, nation, ...) are left alone: they
# are joined by broadcast, and a repartition would only add a stage.
TABLE_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id", "embeddings": "vec_id",
              "events": "event_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = TABLE_KEYS.get(name)
    return ensure_parallel(df, key) if key else df


ROWS_A_TASK = 50_000  # jobs: a job's row is small, but the captions and prompts made of it cost some 0.1 ms


def job_parts(jobs: DataFrame) -> int:
    """Tasks for the jobs, by their number (from the footers, of a table), as their bytes say nothing of
    the work that follows: scans and adaptive shuffles would give a core one task, however many rows."""
    return max(jobs.sparkSession.sparkContext.defaultParallelism, -(-jobs.count() // ROWS_A_TASK))


def _job_keys(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (orders.join(c, orders.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)).select("o_orderkey", "n_name")


def v_job_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, dateline of every caption job: all that its other columns are made of (see ``jobs_of``)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return _job_keys(o, spark, sf_dir).select(F.col("o_orderkey").alias("id"), F.col("n_name").alias("dateline"))


def jobs_of(keys: DataFrame, seed=SEED) -> DataFrame:
    """The rows of ``v_job`` for some of its keys (id, dateline), dealt out by their number, which is
    counted: hand in a table or a checkpoint. Other columns are kept."""
    j = keys.withColumnsRenamed({"id": "o_orderkey", "dateline": "n_name"})
    return _jobs(j.repartition(job_parts(keys), "o_orderkey"), seed)


def in_span(df: DataFrame, key: str, span: tuple[int, int] | None) -> DataFrame:
    """The rows whose key lies in ``span`` (both ends in it); None: all."""
    return df if span is None else df.filter(F.col(key).between(*span))


def v_job(spark: SparkSession, sf_dir: str, seed=SEED, absurd_rate: float = JOB_ABSURD_RATE,
          buckets=None, vocab=V, span: tuple[int, int] | None = None) -> DataFrame:
    """One caption job per order (of a span of order keys): id, accept_order, dateline (customer's
    nation), bucket, role, event, backdrop, shot."""
    o = in_span(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey"), "o_orderkey", span)  # spread below
    j = _job_keys(o, spark, sf_dir).repartition(job_parts(o), "o_orderkey")
    return _jobs(j, seed, absurd_rate, buckets, vocab)


def _jobs(j: DataFrame, seed, absurd_rate: float = JOB_ABSURD_RATE, buckets=None, vocab=V) -> DataFrame:
    j = j.withColumn("_dk", draw_prefix(seed, F.col("o_orderkey")))
    idc = Prefix("_dk")
    others = [c for c in j.columns if c not in ("o_orderkey", "n_name", "_dk")]
    absurd = uniform(seed, idc, "absurd") < F.lit(absurd_rate)
    back_raw = F.when(absurd, choice(seed, idc, "absurd_bg", vocab.ABSURD_BACKDROPS)).otherwise(
        choice(seed, idc, "normal_bg", vocab.BACKDROPS))
    df = j.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("accept_order"),
        F.col("n_name").alias("dateline"),
        choice(seed, idc, "bucket", buckets or vocab.BUCKETS).alias("bucket"),
        choice(seed, idc, "role", vocab.ROLES).alias("role"),
        choice(seed, idc, "event", vocab.EVENTS).alias("event"),
        absurd.alias("mismatch"),
        back_raw.alias("back_raw"),
        weighted_choice_col(uniform(seed, idc, "shot"), vocab.SHOT_TYPES).alias("shot"), *others,
    )
    df = T.add_caption_backdrop(df, "back_raw", "_bc")
    return df.withColumn("back_caption", F.when(F.col("mismatch"), F.col("_bc")).otherwise(F.col("back_raw"))).drop("_bc")


def v_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption candidates from documents: whole texts."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


__all__ = ["table", "v_job", "v_job_key", "jobs_of", "v_cap", "v_face", "v_word", "v_images", "SEED"]


IMG_W = IMG_H = 1024


FACE_LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
WORD_LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def v_face(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Face detections derived from lineitem: one box per line of an order
    (image = order). Raw detector-style doubles; landmarks missing on every
    fifth line; some boxes run off the 1024 x 1024 frame or start outside it."""
    return faces_of(table(spark, sf_dir, "lineitem").select(*FACE_LINES))


def faces_of(li: DataFrame) -> DataFrame:
    """The faces of order lines (FACE_LINES)."""
    x1 = (F.col("l_partkey") * 37 % 1100).cast("double") + F.when(F.col("l_linenumber") % 2 == 0, 0.5).otherwise(0.0)
    y1 = (F.col("l_suppkey") * 53 % 1000).cast("double") + F.when(F.col("l_linenumber") % 3 == 0, 0.5).otherwise(0.25)
    side = F.lit(60.0) + F.col("l_quantity") * 3
    pts = F.col("l_linenumber") % 5 != 0
    return li.select(
        F.col("l_orderkey").alias("img"), F.col("l_linenumber").alias("ix"),
        F.col("l_partkey").alias("ix2"), F.col("l_suppkey").alias("ix3"),
        (F.lit(1.0) - F.col("l_discount") * 3).alias("prob"),
        x1.alias("x1"), y1.alias("y1"), (x1 + side).alias("x2"), (y1 + side).alias("y2"),
        F.when(pts, x1 + side * 0.3).alias("lx"), F.when(pts, y1 + side * 0.4).alias("ly"),
        F.when(pts, x1 + side * 0.7).alias("rx"), F.when(pts, y1 + side * 0.4 + side * F.col("l_tax") * 2).alias("ry"))


def v_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR words derived from lineitem x part: the first word of the part
    name, confidence from the quantity (unparsable on every seventh line),
    boxes in 2x OCR coordinates of the 400 x 256 crop. ``word`` names the row
    (an image may hold several words with one ``ix``)."""
    return words_of(lines_with_word(table(spark, sf_dir, "lineitem").select(*WORD_LINES), spark, sf_dir))


def lines_with_word(li: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines (WORD_LINES) with the first word p_word of their part's name."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.element_at(F.split(F.col("p_name"), " "), 1).alias("p_word"))
    return li.join(p, li.l_partkey == p.p_partkey).drop("p_partkey")


def words_of(j: DataFrame) -> DataFrame:
    """The words of order lines (WORD_LINES and p_word)."""
    conf = F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(
        F.format_string("%.1f", F.col("l_quantity") * 2))
    word = F.col("p_word")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("word"),
        F.col("l_orderkey").alias("img"), F.col("l_linenumber").alias("ix"), word.alias("text"), conf.alias("conf"),
        (F.col("l_suppkey") * 29 % 780).cast("int").alias("left"), (F.col("l_partkey") * 31 % 500).cast("int").alias("top"),
        (F.length(word) * 18 + F.col("l_linenumber")).cast("int").alias("width"), F.lit(22).alias("height"))


def v_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image per order (also those without detections)."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("img"))
