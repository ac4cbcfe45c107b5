"""Single-document JSON files read in parallel (A6, A10, A11), without a task for the whole file.

A file that holds one JSON array or object can't be cut at line ends. Here it is read as
pieces between commas, which Spark splits by byte ranges like lines, and the structure is
found by running sums over small numbers:

1. per piece: how many quotes that aren't escaped, and how far brackets outside of strings
   raise or lower the depth, for either case (the piece begins inside a string or not). An
   escape never spans a comma, so every piece can be judged alone;
2. the running sum of quotes tells which case holds; then the running sum of the right
   numbers is the depth;
3. a comma at depth 1 outside of strings ends a member. Members are numbered by a running
   sum of such commas, and their pieces are put together again.

The running sums are exact and work on blocks (``plans.ranking``), on numbers alone; the
texts are shuffled once. Nothing larger than one member is ever in one place. A folder is
read as the concatenation of its files in name order, so that the writers here can write
one document in parallel, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ranking import DENSE_BITS, ordered_running_sum, sorted_keys
from ..session import cut_lineage
from .sinks import RECORD_SCHEMA

LOW = (1 << 33) - 1


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """pos, value, comma: the pieces in document order, and whether a comma follows."""
    d = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().bitwiseAND(LOW).alias("r"), "value")
    splits = sorted_keys(d.groupBy("f", "b").agg(F.max("r").alias("last")), ["f", "b"], "s")  # a row a file split
    size = splits.withColumn("n", F.col("last") + 1)
    base = ordered_running_sum(size, "n", "s", out="upto", bits=DENSE_BITS).select("f", "b", "last", (F.col("upto") - F.col("n")).alias("base"))
    ends = base.groupBy("f").agg(F.max(F.col("base") + F.col("last")).alias("end"))
    at = base.join(ends, "f").select("f", "b", "base", "end")
    return d.join(at, ["f", "b"]).select((F.col("base") + F.col("r")).alias("pos"), "value", (F.col("base") + F.col("r") < F.col("end")).alias("comma"))


def _depth(text: Column) -> Column:
    def n(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    return (n("[{") - n("]}")).cast("long")


def members(spark: SparkSession, path: str) -> DataFrame:
    """kind ('array' or 'object'), ix (from 0), member: the parts between the commas of the document's
    outermost brackets. None if the document is neither an array nor an object. A document whose
    strings or brackets don't close raises an error."""
    pieces = _pieces(spark, path)
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    d = pieces.withColumn("q", parts)
    even = F.array_join(F.filter("q", lambda _, i: i % 2 == 0), " ")
    odd = F.array_join(F.filter("q", lambda _, i: i % 2 == 1), " ")
    marks = cut_lineage(d.select("pos", "comma", (F.size("q") - 1).cast("long").alias("quotes"), _depth(even).alias("out"), _depth(odd).alias("in")))
    s = ordered_running_sum(marks, "quotes", "pos", out="upto", bits=DENSE_BITS)
    starts_in = F.pmod(F.col("upto") - F.col("quotes"), F.lit(2)) == 1
    s = s.select("pos", "comma", (F.pmod("upto", F.lit(2)) == 1).alias("ends_in"), F.when(starts_in, F.col("in")).otherwise(F.col("out")).alias("step"))
    s = ordered_running_sum(s, "step", "pos", out="depth", bits=DENSE_BITS)
    cut = F.col("comma") & ~F.col("ends_in") & (F.col("depth") == 1)
    s = s.withColumn("cut", cut.cast("long"))
    s = cut_lineage(ordered_running_sum(s, "cut", "pos", out="ix", bits=DENSE_BITS).select("pos", "ends_in", "depth", (F.col("ix") - F.col("cut")).alias("ix")))
    end = s.agg(F.max_by(F.struct("depth", "ends_in"), "pos").alias("e"), F.max("ix").alias("last")).first()
    if end.e is None:
        return spark.createDataFrame([], "kind string, ix long, member string")
    if end.e.depth != 0 or end.e.ends_in:
        raise ValueError(f"{path}: a bracket or string isn't closed")
    d = pieces.join(s.select("pos", "ix"), "pos")
    text = F.concat(F.col("value"), F.when(F.col("comma"), F.lit(",")).otherwise(F.lit("")))
    one = d.groupBy("ix").agg(F.sort_array(F.collect_list(F.struct("pos", text.alias("t")))).alias("p"))
    whole = F.array_join(F.transform("p", lambda p: p["t"]), "")
    whole = F.when(F.col("ix") < end.last, F.regexp_replace(whole, ",$", "")).otherwise(F.regexp_replace(whole, r"[\]}]\s*$", ""))
    first = d.filter("ix = 0").agg(F.min_by(F.regexp_extract("value", r"^\s*([\[{])", 1), F.when(F.trim("value") != "", F.col("pos"))).alias("k")).first().k
    if first not in ("[", "{"):
        return spark.createDataFrame([], "kind string, ix long, member string")
    whole = F.when(F.col("ix") == 0, F.regexp_replace(whole, r"^\s*[\[{]", "")).otherwise(whole)
    out = one.select(F.lit("array" if first == "[" else "object").alias("kind"), "ix", F.regexp_replace(whole, r"^\s+|\s+$", "").alias("member"))
    return out.filter("member != ''")


def read_snapshot_array(spark: SparkSession, path: str) -> DataFrame:
    """The records of a snapshot that is one JSON array. A document that isn't an array has
    none; an entry that isn't an object is a record without a caption (all null)."""
    m = members(spark, path).filter("kind = 'array'")
    r = F.when(F.col("member").startswith("{"), F.from_json("member", RECORD_SCHEMA, {"mode": "FAILFAST"}))
    return m.select(r.alias("r")).select("r.*")


def _by_id(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """ix, id, v of a document that is one object: its members, parsed one by one."""
    m = members(spark, path).filter("kind = 'object'")
    m = m.select("ix", F.from_json(F.concat(F.lit("{"), F.col("member"), F.lit("}")), f"map<string,{kind}>", {"mode": "FAILFAST"}).alias("m"))
    return m.select("ix", F.explode("m").alias("id", "v"))


def last_of_id(df: DataFrame) -> DataFrame:
    """A repeated name counts once, with its last value, as JSON readers have it."""
    return df.groupBy("id").agg(F.max(F.struct("ix", "v")).alias("r")).select("id", "r.ix", "r.v")


def read_grounding_object(spark: SparkSession, path: str, last_wins: bool = True) -> DataFrame:
    """A10: id, token of the official file, one object of id -> token list; an empty list keeps one
    row with a null token. ``last_wins=False`` keeps every occurrence of a repeated id."""
    d = _by_id(spark, path, "array<int>")
    return (last_of_id(d) if last_wins else d).select("id", F.explode_outer("v").alias("token"))


def read_explanations_object(spark: SparkSession, path: str) -> DataFrame:
    """Id, tokens, regions of one object of id -> explanation."""
    return _by_id(spark, path, "struct<tokens:array<int>,regions:array<array<double>>>").groupBy("id").agg(
        F.max_by("v", "ix").alias("v")).select("id", "v.tokens", "v.regions")


def write_document(df: DataFrame, member: Column, order_col: str, path: str, brackets: str = "[]") -> None:
    """One JSON document over several part files, which are the document when put together
    in name order. ``order_col`` is unique."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        df.sparkSession.createDataFrame([(brackets,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    o = F.col(order_col)
    line = F.concat(F.when(o == lo, F.lit(brackets[0])).otherwise(F.lit("")), member, F.when(o == hi, F.lit(brackets[1])).otherwise(F.lit(",")))
    df.repartitionByRange(order_col).sortWithinPartitions(order_col).select(line.alias("value")).write.mode("overwrite").text(path)


def write_snapshot_array(df: DataFrame, path: str, order_col: str = "id") -> str:
    """B2 in the official form: all records as one array."""
    write_document(df, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), order_col, path)
    return path


def write_grounding_object(df: DataFrame, path: str, id_col: str = "id", tokens_col: str = "tokens") -> None:
    """B7 in the official form: one object of id -> token list."""
    one = F.to_json(F.create_map(F.col(id_col).cast("string"), F.col(tokens_col)))
    write_document(df, F.substring(one, 2, F.length(one) - 2), id_col, path, "{}")
