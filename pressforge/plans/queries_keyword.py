"""Registered queries: keyword join (F2), single-document JSON files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators.keywords import keyword_join
from ..session import cut_lineage, scratch_dir
from ..sources import jsonfile as J
from .pipeline import all_records, records_as_text
from .queries_core import ALL_RECORDS_SQL
from .queries_eval import EV_SQL
from .queries_release import _explanations, _submission
from . import sqlgen as Q
from .registry import register
from .views import SEED, table, v_cap

# the keyword table: words of the part names, of the benchmark items (from five letters on) and all
# nation names, each with where it comes from
_KW_SQL = ("SELECT DISTINCT 'part' AS tag, unnest(string_split(p_name, ' ')) AS keyword FROM part "
           "UNION SELECT 'item', w FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{5,}')) AS w FROM benchmark) "
           "UNION SELECT 'nation', n_name FROM nation UNION SELECT 'short', substr(n_name, 1, 2) FROM nation")


def v_keyword(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.lit("part").alias("tag"), F.explode(F.split("p_name", " ")).alias("keyword"))
    item = table(spark, sf_dir, "benchmark").select(F.lit("item").alias("tag"), F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]{5,})"), 1)).alias("keyword"))
    n = table(spark, sf_dir, "nation")
    nation = n.select(F.lit("nation").alias("tag"), F.col("n_name").alias("keyword"))
    short = n.select(F.lit("short").alias("tag"), F.substring("n_name", 1, 2).alias("keyword"))
    return part.union(item).union(nation).union(short).distinct()


@register("keyword_join", f"SELECT doc_id AS id, tag, keyword FROM documents JOIN ({_KW_SQL}) k ON contains(lower(text), lower(keyword)) AND keyword <> ''")
def q_keyword_join(spark, sf_dir):
    """the keywords of a table that each document's whole text contains."""
    return keyword_join(v_cap(spark, sf_dir), v_keyword(spark, sf_dir)).select("id", "tag", "keyword")


@register("scan_snapshot_array", f"SELECT * FROM ({ALL_RECORDS_SQL})")
def q_scan_snapshot_array(spark, sf_dir):
    """A6 + B2: the snapshot as one JSON array, written and read in parallel. The writer reads its
    rows for the bounds, the ranges and the lines; they are made once."""
    path = os.path.join(scratch_dir(spark, "array"), "metadata.json")
    return records_as_text(J.read_snapshot_array(spark, J.write_snapshot_array(cut_lineage(all_records(spark, sf_dir)), path)))


@register("scan_grounding_object",
          f"SELECT cast(id AS VARCHAR) AS id, cast(unnest(CASE WHEN len(pred_tokens) = 0 THEN [NULL] ELSE pred_tokens END) AS INTEGER) AS token FROM ({EV_SQL})")
def q_scan_grounding_object(spark, sf_dir):
    """A10 + B7: the grounding file in its official form, one object of id -> tokens."""
    path = os.path.join(scratch_dir(spark, "grounding"), "text_grounding.json")
    J.write_grounding_object(_submission(spark, sf_dir), path)
    return J.read_grounding_object(spark, path).select("id", F.col("token").cast("int").alias("token"))


@register("scan_explanations_object",
          f"SELECT cast(id AS VARCHAR) AS id, len(pred_tokens[1:3]) + CASE WHEN {Q.uniform(SEED, 'cast(id AS VARCHAR)', 'xtok')} < 0.1 THEN 1 ELSE 0 END AS n_tokens, "
          f"1 AS n_regions FROM ({EV_SQL}) WHERE pred_label = 'manipulated'")
def q_scan_explanations_object(spark, sf_dir):
    """The explanation file as one object, read back."""
    path = os.path.join(scratch_dir(spark, "explanations"), "explanations.json")
    one = F.to_json(F.create_map("id", F.struct(F.col("e_tokens").alias("tokens"), "regions")))
    J.write_document(_explanations(spark, sf_dir), F.substring(one, 2, F.length(one) - 2), "id", path, "{}")
    return J.read_explanations_object(spark, path).select("id", F.size("tokens").alias("n_tokens"), F.size("regions").alias("n_regions"))
