"""Sources (A1-A11): gazetteers, metadata logs, snapshots and submissions."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..plans.ranking import DENSE_BITS, ordered_rank, ordered_running_sum, sorted_keys
from .sinks import RECORD_SCHEMA

NAME_COLUMNS = ["city_ascii", "city", "name"]
CLASSIFICATION_SCHEMA = "id STRING, label STRING, confidence DOUBLE, manipulation_type STRING"
GROUNDING_TYPE = "map<string,array<int>>"
EXPLANATION_TYPE = "map<string,struct<tokens:array<int>,regions:array<array<double>>>>"


UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE", "MALFORMED_", "INVALID_CSV", "UNSUPPORTED_DATA_TYPE")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's file system (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder and what is in it through the cluster's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _first_names(df: DataFrame, name: F.Column, max_items: int | None) -> DataFrame:
    """Rows with a name, in file order (by file name, then by place in the file); the first
    ``max_items`` if given; then the first occurrence of each name (order-preserving distinct, J1 / I1).

    Spark reads a file's lines in order within a split, so the row's number inside its split
    (the low bits of the row id) follows the split's own place."""
    f = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    low = (1 << 33) - 1
    d = df.select(f[0].alias("_f"), f[1].alias("_b"), F.monotonically_increasing_id().bitwiseAND(low).alias("_r"), name.alias("name"))
    d = d.filter(F.col("name") != "")
    splits = sorted_keys(d.groupBy("_f", "_b").agg((F.max("_r") + 1).alias("_m")), ["_f", "_b"], "_s")  # one row per file split
    base = ordered_running_sum(splits, "_m", "_s", out="_o", bits=DENSE_BITS).select("_f", "_b", (F.col("_o") - F.col("_m")).alias("_o"))
    d = d.join(base, ["_f", "_b"]).select("name", (F.col("_o") + F.col("_r")).alias("_pos"))
    d = ordered_rank(d, "_pos", None, out="pos", bits=DENSE_BITS)
    if max_items is not None:
        d = d.filter(F.col("pos") <= max_items)
    return d.groupBy("name").agg(F.min("pos").alias("first_pos"))


def city_names_csv(spark: SparkSession, path: str, max_items: int | None = None) -> DataFrame:
    """A1: header CSV (quotes doubled inside quotes); first non-empty of city_ascii / city / name,
    stripped; blank names dropped."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    cols = [F.nullif(strip(F.col(c)), F.lit("")) for c in NAME_COLUMNS if c in df.columns]
    if not cols:
        return spark.createDataFrame([], "name string, first_pos bigint")
    return _first_names(df, F.coalesce(*cols), max_items)


def city_names_tsv(spark: SparkSession, path: str, max_items: int | None = None) -> DataFrame:
    """A2: headerless TSV, field 1, quoting off; lines without the field are skipped."""
    df = spark.read.option("sep", "\t").option("quote", "").option("header", False).csv(path)
    if "_c1" not in df.columns:
        return spark.createDataFrame([], "name string, first_pos bigint")
    return _first_names(df, strip(F.col("_c1")), max_items)


def datelines(spark: SparkSession, paths: list[str], max_items: int | None = None) -> DataFrame:
    """A3: ordered source fallback; the first source that yields a name wins."""
    for p in paths:
        try:
            if not path_exists(spark, p):
                continue
            names = city_names_csv(spark, p, max_items) if p.lower().endswith(".csv") else city_names_tsv(spark, p, max_items)
            if names.limit(1).count() > 0:
                return names
        except PySparkException as e:  # a source that can't be read is skipped; a failing cluster is not its fault
            if not (e.getCondition() or "").startswith(UNREADABLE):
                raise
    raise RuntimeError("no dateline source yielded a name")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A5: JSON Lines metadata with a fixed schema; blank lines skipped, a
    malformed line fails the read."""
    return spark.read.schema(RECORD_SCHEMA).option("mode", "FAILFAST").json(path)


def read_snapshot(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Snapshot; ``multiline`` for a single JSON array file."""
    return spark.read.schema(RECORD_SCHEMA).option("multiLine", multiline).json(path)


def read_metadata(spark: SparkSession, jsonl: str, snapshot: str) -> DataFrame:
    """The JSONL log if it exists, else the snapshot (never both)."""
    return read_jsonl(spark, jsonl) if path_exists(spark, jsonl) else read_snapshot(spark, snapshot)


def read_classification(spark: SparkSession, path: str) -> DataFrame:
    """Classification.csv with header."""
    return spark.read.schema(CLASSIFICATION_SCHEMA).option("header", True).csv(path)


def read_grounding_lines(spark: SparkSession, path: str) -> DataFrame:
    """A10: one ``{"id": [..]}`` object per line (what
    ``sinks.grounding_lines`` writes); parsed in parallel."""
    m = spark.read.text(path).select(F.from_json("value", GROUNDING_TYPE).alias("m"))
    return m.select(F.explode("m").alias("id", "tokens")).select("id", F.explode_outer("tokens").alias("token"))


def read_explanations(spark: SparkSession, path: str) -> DataFrame:
    """Optional explanation file, one ``{"id": {...}}`` object per line, one row per id."""
    m = spark.read.text(path).select(F.from_json("value", EXPLANATION_TYPE).alias("m"))
    return m.select(F.explode("m").alias("id", "e")).select("id", "e.tokens", "e.regions")
