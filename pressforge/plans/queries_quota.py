"""Registered queries: run state, quotas and ordered bookkeeping
(G1, G2, E10, E12, H4-H7, B6, J2, F10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import draw, uniform
from ..operators import quota as QU
from ..sources.sinks import image_path
from . import oracle as O
from . import sqlgen as Q
from .pipeline import goals_of
from .registry import register
from .views import SEED, table, v_job

# goals of the resumed run, as a share of a class's jobs: about a third is accepted already, so
# there is something left to build at any size, and one class is complete
RESUME_SHARE = {"lit": 0.6, "inv": 0.5, "irr": 0.25}
BUDGET_CAP = 5000


def _jobs_status(spark, sf_dir):
    """Jobs split by order status: 'F' rows were accepted in an earlier run."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    return v_job(spark, sf_dir).join(o, "id").withColumn("is_old", F.col("o_orderstatus") == "F")


JOBS_SQL = f"SELECT j.*, o_orderstatus = 'F' AS is_old FROM ({O.v_job_sql()}) j JOIN orders ON j.id = o_orderkey"
_DOMAIN = "(SELECT unnest(" + Q.lst(V.BUCKETS) + ") AS bucket)"
_HAVE_SQL = (f"SELECT d.bucket, cast(coalesce(n, 0) AS BIGINT) AS n FROM {_DOMAIN} d LEFT JOIN "
             f"(SELECT bucket, count(*) AS n FROM ({JOBS_SQL}) WHERE is_old GROUP BY bucket) c ON d.bucket = c.bucket")
_GOALS_SQL = (f"SELECT bucket, cast(floor(count(*) * CASE bucket " + " ".join(f"WHEN '{k}' THEN cast({v} AS DOUBLE)" for k, v in RESUME_SHARE.items())
              + f" END) AS BIGINT) AS goal FROM ({JOBS_SQL}) GROUP BY bucket")
_REM_SQL = (f"SELECT h.bucket, n AS have, coalesce(goal, 0) AS goal, greatest(cast(0 AS BIGINT), coalesce(goal, 0) - n) AS remainder "
            f"FROM ({_HAVE_SQL}) h LEFT JOIN ({_GOALS_SQL}) g ON h.bucket = g.bucket")


def _remainder_df(spark, sf_dir):
    j = _jobs_status(spark, sf_dir)
    return QU.remainder(QU.bucket_counts(j.filter("is_old")), goals_of(j, RESUME_SHARE))


def _remainders(spark, sf_dir) -> dict[str, int]:
    """Three numbers (one per class) read on the driver to size the run."""
    return {r["bucket"]: int(r["remainder"]) for r in _remainder_df(spark, sf_dir).collect()}


@register("bucket_counts", _HAVE_SQL)
def q_bucket_counts(spark, sf_dir):
    """G1: accepted rows per class, zero rows included."""
    return QU.bucket_counts(_jobs_status(spark, sf_dir).filter("is_old"))


@register("resume_remainder", _REM_SQL)
def q_resume_remainder(spark, sf_dir):
    """What is still to build per class."""
    return _remainder_df(spark, sf_dir)


@register("pool_sizing",
          "SELECT n_nationkey, total, cast(greatest(600, cast(trunc(total * CASE WHEN total >= 400 THEN 2.4 ELSE 4.0 END) AS BIGINT)) AS BIGINT) AS pool, "
          "cast(greatest(200, cast(trunc(total * 0.1) AS BIGINT)) AS BIGINT) AS backup FROM (SELECT n_nationkey, count(o_orderkey) AS total "
          "FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_nationkey)")
def q_pool_sizing(spark, sf_dir):
    """E10 on per-nation job totals."""
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    t = (n.join(c, n.n_nationkey == c.c_nationkey, "left").join(o, c.c_custkey == o.o_custkey, "left")
         .groupBy("n_nationkey").agg(F.count("o_orderkey").alias("total")))
    pool, backup = QU.pool_sizing(F.col("total"))
    return t.select("n_nationkey", "total", pool.alias("pool"), backup.alias("backup"))


_NEW_SQL = f"SELECT * FROM ({JOBS_SQL}) WHERE NOT is_old"
_FILL_SQL = (f"SELECT n.id, n.bucket FROM ({_NEW_SQL}) n JOIN ({_REM_SQL}) r ON n.bucket = r.bucket "
             f"QUALIFY row_number() OVER (PARTITION BY n.bucket ORDER BY n.accept_order) <= r.remainder")


@register("quota_fill", _FILL_SQL)
def q_quota_fill(spark, sf_dir):
    """H4: first ``remainder`` new jobs per class in arrival order."""
    rem = _remainders(spark, sf_dir)
    new = _jobs_status(spark, sf_dir).filter(~F.col("is_old")).select("id", "bucket", "accept_order")
    return QU.quota_fill(new, rem).select("id", "bucket")


@register("run_summary",
          f"SELECT r.bucket, r.have AS prior, cast(coalesce(f.n, 0) AS BIGINT) AS this_run, r.have + cast(coalesce(f.n, 0) AS BIGINT) AS total "
          f"FROM ({_REM_SQL}) r LEFT JOIN (SELECT bucket, count(*) AS n FROM ({_FILL_SQL}) GROUP BY bucket) f ON r.bucket = f.bucket")
def q_run_summary(spark, sf_dir):
    """Saved this run and per-class totals = prior + this run."""
    rem = _remainder_df(spark, sf_dir)
    new = _jobs_status(spark, sf_dir).filter(~F.col("is_old")).select("id", "bucket", "accept_order")
    filled = QU.quota_fill(new, {r["bucket"]: int(r["remainder"]) for r in rem.collect()})
    n = filled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return (rem.join(n, "bucket", "left")
            .select("bucket", F.col("have").alias("prior"), F.coalesce("n", F.lit(0)).cast("bigint").alias("this_run"),
                    (F.col("have") + F.coalesce("n", F.lit(0))).cast("bigint").alias("total")))


@register("snapshot_versions",
          f"SELECT id, arrival, cast(ceil(arrival / {V.SNAP_EVERY}) AS BIGINT) AS version, arrival % {V.SNAP_EVERY} = 0 AS is_snapshot "
          f"FROM (SELECT id, row_number() OVER (ORDER BY accept_order) AS arrival FROM ({O.v_job_sql()}))")
def q_snapshot_versions(spark, sf_dir):
    """H5 / M4: arrival number, snapshot version, snapshot boundary."""
    return QU.snapshot_versions(v_job(spark, sf_dir).select("id", "accept_order")).select("id", "arrival", "version", "is_snapshot")


_CALLS_SQL = f"(1 + {Q.draw(SEED, 'id', 'calls')} % 2)"


@register("budget_cap",
          f"SELECT id, calls_so_far FROM (SELECT id, sum({_CALLS_SQL}) OVER (ORDER BY accept_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
          f"AS calls_so_far FROM ({O.v_job_sql()})) WHERE calls_so_far <= {BUDGET_CAP}")
def q_budget_cap(spark, sf_dir):
    """H6: jobs that fit in the image-call budget (1 or 2 calls each)."""
    j = v_job(spark, sf_dir).select("id", "accept_order", (F.lit(1) + F.pmod(draw(SEED, F.col("id"), "calls"), F.lit(2))).alias("calls"))
    return QU.budget_cap(j, "calls", BUDGET_CAP).select("id", F.col("calls_so_far").cast("bigint").alias("calls_so_far"))


@register("assign_ids",
          f"SELECT id, (SELECT max(id) FROM ({JOBS_SQL}) WHERE is_old) + row_number() OVER (ORDER BY accept_order) AS new_id "
          f"FROM ({_NEW_SQL})")
def q_assign_ids(spark, sf_dir):
    """H7: new rows continue after the largest stored id (no reuse on resume)."""
    j = _jobs_status(spark, sf_dir)
    top = QU.max_id(j.filter("is_old"))
    return QU.assign_ids(j.filter(~F.col("is_old")).select("id", "accept_order"), top).select("id", "new_id")


def _slots_sql(rem_sql: str) -> str:
    order = {b: i for i, b in enumerate(V.BUCKETS)}
    bix = "CASE bucket " + " ".join(f"WHEN '{b}' THEN {i}" for b, i in order.items()) + " END"
    key = Q.draw(SEED, "bucket || ':' || cast(slot AS VARCHAR)", "slot")
    return (f"SELECT bucket, row_number() OVER (ORDER BY {key}, {bix}, slot) AS srank FROM "
            f"(SELECT bucket, unnest(range(1, remainder + 1)) AS slot FROM ({rem_sql}) WHERE remainder > 0)")


@register("bucket_assign",
          f"SELECT j.id, s.bucket, j.job_rank FROM (SELECT id, row_number() OVER (ORDER BY accept_order) AS job_rank FROM ({_NEW_SQL})) j "
          f"JOIN ({_slots_sql(_REM_SQL)}) s ON j.job_rank = s.srank")
def q_bucket_assign(spark, sf_dir):
    """Quota slots handed out in a seeded random order to new jobs."""
    rem = _remainders(spark, sf_dir)
    new = _jobs_status(spark, sf_dir).filter(~F.col("is_old")).select("id", "accept_order")
    return QU.bucket_assign(new, rem, SEED).select("id", "bucket", "job_rank")


@register("records_union",
          f"SELECT id, bucket, is_old FROM ({JOBS_SQL}) WHERE is_old UNION ALL SELECT n.id, n.bucket, false FROM ({_FILL_SQL}) n")
def q_records_union(spark, sf_dir):
    """Stored records plus this run's."""
    j = _jobs_status(spark, sf_dir)
    old = j.filter("is_old").select("id", "bucket", "is_old")
    new = QU.quota_fill(j.filter(~F.col("is_old")).select("id", "bucket", "accept_order"), _remainders(spark, sf_dir))
    return old.unionByName(new.select("id", "bucket", F.lit(False).alias("is_old")))


_IMG_SQL = O.image_path_sql("bucket", "id")


@register("orphan_audit",
          f"SELECT coalesce(f.path, m.path) AS path, f.path IS NOT NULL AS has_file, m.path IS NOT NULL AS has_meta FROM "
          f"(SELECT {_IMG_SQL} AS path FROM ({JOBS_SQL}) WHERE is_old AND {Q.uniform(SEED, 'id', 'file')} >= 0.03) f FULL OUTER JOIN "
          f"(SELECT {_IMG_SQL} AS path FROM ({JOBS_SQL}) WHERE is_old AND {Q.uniform(SEED, 'id', 'meta')} >= 0.02) m ON f.path = m.path "
          f"WHERE f.path IS NULL OR m.path IS NULL")
def q_orphan_audit(spark, sf_dir):
    """image files vs metadata rows (3% of files and 2% of metadata
    rows lost); full outer join on the relative path, mismatches only."""
    j = _jobs_status(spark, sf_dir).filter("is_old").withColumn("path", image_path(F.col("bucket"), F.col("id"), SEED))
    files = j.filter(uniform(SEED, F.col("id"), "file") >= 0.03).select(F.col("path").alias("fpath"))
    meta = j.filter(uniform(SEED, F.col("id"), "meta") >= 0.02).select(F.col("path").alias("mpath"))
    a = files.join(meta, files.fpath == meta.mpath, "full_outer")
    return (a.filter(F.col("fpath").isNull() | F.col("mpath").isNull())
            .select(F.coalesce("fpath", "mpath").alias("path"), F.col("fpath").isNotNull().alias("has_file"),
                    F.col("mpath").isNotNull().alias("has_meta")))


@register("image_paths", f"SELECT id, {_IMG_SQL} AS image FROM ({O.v_job_sql()})")
def q_image_paths(spark, sf_dir):
    """Relative image path per job."""
    return v_job(spark, sf_dir).select("id", image_path(F.col("bucket"), F.col("id"), SEED).alias("image"))
