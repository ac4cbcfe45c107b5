"""Per-class quotas, run state and ordered bookkeeping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import draw
from ..plans.ranking import DENSE_BITS, block_offsets, ordered_rank, ordered_running_sum


def _map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def bucket_domain(spark: SparkSession, buckets=None) -> DataFrame:
    return spark.createDataFrame([(b,) for b in (buckets or V.BUCKETS)], "bucket string")


def bucket_counts(df: DataFrame, bucket_col: str = "bucket", buckets=None) -> DataFrame:
    """G1: rows per bucket, zero for buckets with no rows."""
    have = df.groupBy(F.col(bucket_col).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    dom = bucket_domain(df.sparkSession, buckets)
    return dom.join(have, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def remainder(have: DataFrame, goals: dict[str, int]) -> DataFrame:
    """max(0, goal - have) per bucket (``have`` from bucket_counts)."""
    return have.select("bucket", F.col("n").alias("have"),
                       F.coalesce(F.element_at(_map(goals), F.col("bucket")), F.lit(0)).cast("bigint").alias("goal")) \
        .withColumn("remainder", F.greatest(F.lit(0).cast("bigint"), F.col("goal") - F.col("have")))


def pool_sizing(total: Column) -> tuple[Column, Column]:
    """Scene pool size and backup-slice size for a remaining total."""
    mult = F.when(total >= V.POOL_BIG_AT, F.lit(V.POOL_MULT_BIG)).otherwise(F.lit(V.POOL_MULT_SMALL))
    pool = F.greatest(F.lit(V.POOL_MIN).cast("bigint"), (total * mult).cast("bigint"))
    backup = F.greatest(F.lit(V.BACKUP_MIN).cast("bigint"), (total * F.lit(V.BACKUP_FRAC)).cast("bigint"))
    return pool, backup


def quota_cutoffs(df: DataFrame, goals: dict[str, int], order_col: str = "accept_order", bucket_col: str = "bucket") -> dict[str, int | None]:
    """The order value of the last row that each bucket's quota takes, None where it takes all.

    Block counts and their running sums tell in which block of the order a quota ends (one row a
    bucket is read), and only that block, at most 2^16 rows of a bucket, is ranked. Both passes
    read the two columns alone."""
    live = {b: int(g) for b, g in goals.items() if int(g) > 0}
    if not live:
        return {}
    d = df.filter(F.col(bucket_col).isin(list(live))).select(F.col(bucket_col).alias("b"), F.col(order_col).cast("bigint").alias("o"))
    d = d.withColumn("_blk", F.shiftright("o", DENSE_BITS))
    stats = d.groupBy("b", "_blk").agg(F.count(F.lit(1)).alias("n"))
    goal = F.element_at(_map(live), F.col("b"))
    ends = (stats.join(block_offsets(stats, ["b"], "n", DENSE_BITS), ["b", "_blk"]).filter((F.col("_off") < goal) & (goal <= F.col("_off") + F.col("n")))
            .select("b", "_blk", (goal - F.col("_off")).alias("need")).collect())
    cuts: dict[str, int | None] = dict.fromkeys(live)
    if ends:
        here = [(F.col("b") == r.b) & (F.col("_blk") == r._blk) for r in ends]
        need = F.element_at(_map({r.b: int(r.need) for r in ends}), F.col("b"))
        rank = F.row_number().over(Window.partitionBy("b").orderBy("o"))
        last = d.filter(reduce(lambda x, y: x | y, here)).withColumn("_rank", rank).filter(F.col("_rank") == need)
        cuts |= {r.b: r.o for r in last.select("b", "o").collect()}
    return cuts


def quota_fill(df: DataFrame, goals: dict[str, int] | Column, order_col: str = "accept_order",
               bucket_col: str = "bucket") -> DataFrame:
    """H4: keep the first ``goal`` rows of each bucket in arrival order.

    Goals per bucket become cut-off values, so the rows themselves are only filtered, not
    shuffled; ``df`` is read three times (its two key columns twice), so hand in a table or a
    checkpoint. Goals as a column are compared with the block-split exact rank."""
    if not isinstance(goals, dict):
        r = ordered_rank(df, order_col, [bucket_col], out="_qrank", bits=DENSE_BITS)
        return r.filter(F.col("_qrank") <= goals).drop("_qrank")
    b, o = F.col(bucket_col), F.col(order_col)
    cuts = quota_cutoffs(df, goals, order_col, bucket_col)
    return df.filter(reduce(lambda x, y: x | y, [(b == k) if c is None else (b == k) & (o <= c) for k, c in cuts.items()], F.lit(False)))


def snapshot_versions(df: DataFrame, order_col: str = "accept_order", every: int = V.SNAP_EVERY) -> DataFrame:
    """H5: arrival number, snapshot version and snapshot boundary flag."""
    r = ordered_rank(df, order_col, None, out="arrival", bits=DENSE_BITS)
    return (r.withColumn("version", F.ceil(F.col("arrival") / F.lit(every)).cast("bigint"))
            .withColumn("is_snapshot", F.pmod(F.col("arrival"), F.lit(every)) == 0))


def budget_cap(df: DataFrame, calls_col: str, cap: int, order_col: str = "accept_order") -> DataFrame:
    """H6: rows whose cumulative call count stays within ``cap``."""
    r = ordered_running_sum(df, calls_col, order_col, None, out="calls_so_far", bits=DENSE_BITS)
    return r.filter(F.col("calls_so_far") <= F.lit(cap))


def assign_ids(new: DataFrame, existing_max_id: int, order_col: str = "accept_order") -> DataFrame:
    """H7: ids continue after the largest existing id, in arrival order
    (never reuses an id after a resume)."""
    r = ordered_rank(new, order_col, None, out="_rn", bits=DENSE_BITS)
    return r.withColumn("new_id", (F.lit(int(existing_max_id)) + F.col("_rn")).cast("bigint")).drop("_rn")


def max_id(df: DataFrame, id_col: str = "id") -> int:
    """Scalar aggregate read on the driver (one number)."""
    v = df.agg(F.max(id_col)).first()[0]
    return int(v) if v is not None else 0


def bucket_assign(jobs: DataFrame, remainders: dict[str, int], seed, order_col: str = "accept_order",
                  buckets=None) -> DataFrame:
    """Hand out quota slots in a seeded random order to jobs in arrival
    order. Slot rows = the total remainder (the output size), never the input.

    Slot order is (draw, bucket index, slot number); blocks are cut on the
    32-bit draw and ties ordered by the rest."""
    spark = jobs.sparkSession
    order = list(buckets or V.BUCKETS)
    live = [(b, int(n)) for b, n in remainders.items() if int(n) > 0]
    total = sum(n for _, n in live)
    base = jobs.drop("bucket") if "bucket" in jobs.columns else jobs
    if not total:  # every quota is met
        return base.withColumns({"job_rank": F.lit(0).cast("bigint"), "bucket": F.lit(None).cast("string")}).limit(0)
    # distributed slot generation: one range, cut into per-bucket intervals
    bucket, bix, start, acc = None, None, None, 0
    for b, n in live:
        cond = F.col("id") < F.lit(acc + n)
        bucket = F.when(cond, F.lit(b)) if bucket is None else bucket.when(cond, F.lit(b))
        bix = F.when(cond, F.lit(order.index(b))) if bix is None else bix.when(cond, F.lit(order.index(b)))
        start = F.when(cond, F.lit(acc)) if start is None else start.when(cond, F.lit(acc))
        acc += n
    slots = spark.range(0, total).select(bucket.alias("bucket"), bix.alias("bix"),
                                         (F.col("id") - start + 1).alias("slot"))
    key = draw(seed, F.concat_ws(":", F.col("bucket"), F.col("slot").cast("string")), "slot")
    slots = slots.withColumn("_ord", key)
    slots = ordered_rank(slots, "_ord", None, out="_srank", bits=12, tiebreak=["bix", "slot"]).select("bucket", "_srank")
    j = ordered_rank(base, order_col, None, out="job_rank", bits=DENSE_BITS)
    return j.join(slots, j["job_rank"] == slots["_srank"]).drop("_srank")
