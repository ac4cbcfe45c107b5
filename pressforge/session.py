"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "pressforge", master: str | None = None,
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    On a cluster ``master`` stays None and the cluster's own settings win;
    the UI stays off because nothing here serves pages.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # broadcast only what the planner has measured to be small
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in defaults.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set by the cluster. Only a local-mode session (tests, bench) without the
    setting gets a fresh scratch folder; a cluster without it is an error
    because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="pf-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint: lost executors must not lose the data)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


JIT_BYTES = 8000


def compiled_methods(df: DataFrame) -> DataFrame:
    """The JVM leaves methods of more than 8,000 bytes of code interpreted. Plans whose generated
    methods would be larger are run operator by operator, in small methods (a setting of the session;
    a smaller one stays)."""
    conf, key = df.sparkSession.conf, "spark.sql.codegen.hugeMethodLimit"
    if int(conf.get(key, "65535")) > JIT_BYTES:
        conf.set(key, str(JIT_BYTES))
    return df


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for round-trip writes: under the shared checkpoint
    folder on a cluster, a new temp folder in local mode."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") and not spark.conf.get("spark.checkpoint.dir", None):
        return tempfile.mkdtemp(prefix=f"pf-{name}-")
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")


def ensure_parallel(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread the rows of a scan that has fewer splits than there are cores (small files of one row
    group each) by ``key``; a scan with enough splits is left as it is. The same rule in any
    session.

    Call it on a plain scan only: on a plan that already contains a shuffle,
    asking adaptive execution for the partition count runs those stages."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= want:
            return df
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a Connect session): leave as is
        return df
    return df.repartition(want, key) if key else df.repartition(want)
