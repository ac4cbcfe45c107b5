"""Keyword tagging and semantic matching.

Keyword tables are fixed-size configuration, so tagging is a row-local
expression (no join, no shuffle): every tag is one OR-chain of substring
tests, compiled into the whole-stage-codegen pipeline of the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.sampling import choice_from, sql_str
from ..functions.text import contains_any


def text_tags(txt, table: dict[str, list[str]] | None = None, default: str = V.DEFAULT_TAG) -> Column:
    """Sorted tag set of ``txt`` against ``table``; ``[default]`` when none hit."""
    table = table if table is not None else V.EVENT_TAGS
    t = F.lower(txt if isinstance(txt, Column) else F.col(txt))
    hits = _tag_hits([(tag, contains_any(t, kws)) for tag, kws in table.items()])
    return F.sort_array(F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(default))))


def _tag_hits(conds) -> Column:
    """Tags whose condition holds, as a concat of one-element arrays (stays
    in generated code; a lambda-based compact would not)."""
    empty = F.array().cast("array<string>")
    return F.concat(*[F.when(c, F.array(F.lit(tag))).otherwise(empty) for tag, c in conds])


def _or_contains(lc: Column, kws) -> Column:
    out = None
    for k in kws:
        c = lc.contains(k)
        out = c if out is None else (out | c)
    return out


def add_text_tags(df: DataFrame, src: str, out: str, table: dict[str, list[str]] | None = None,
                  default: str = V.DEFAULT_TAG) -> DataFrame:
    """D1 / D2, DataFrame form: the text is lower-cased once into a column and
    every keyword is a plain ``contains`` (indexOf) on it."""
    table = table if table is not None else V.EVENT_TAGS
    d = df.withColumn("_lc", F.lower(F.col(src)))
    parts = []
    for tag, kws in table.items():
        cond = " OR ".join(f"contains(_lc, {sql_str(k)})" for k in kws)
        parts.append(f"if({cond}, array({sql_str(tag)}), cast(array() as array<string>))")
    d = d.withColumn(out, F.expr("concat(" + ", ".join(parts) + ")")).drop("_lc")
    return d.withColumn(out, F.sort_array(F.when(F.size(out) > 0, F.col(out)).otherwise(F.array(F.lit(default)))))


def role_tags(role) -> Column:
    """D1."""
    return text_tags(role, V.ROLE_RULES)


def tag_union(a: Column, b: Column) -> Column:
    """D3 / J3."""
    return F.sort_array(F.array_union(a, b))


def semantic_match(role_t: Column, event_t: Column, back_t: Column) -> Column:
    """(role & event) and ((role & back) or (event & back))."""
    return F.arrays_overlap(role_t, event_t) & (F.arrays_overlap(role_t, back_t) | F.arrays_overlap(event_t, back_t))


def objects_for(tag: Column, table: dict[str, list[str]] | None = None) -> Column:
    """Object list for a tag, falling back to the default tag's list."""
    table = table or V.OBJECTS_BY_TAG
    m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(o) for o in v]))])
    return F.coalesce(F.element_at(m, tag), F.element_at(m, F.lit(V.DEFAULT_TAG)))


def tag_choice(tags: Column, seed, key, slot="tag") -> Column:
    """Uniform pick from the sorted tag set; default tag when empty."""
    return F.coalesce(choice_from(F.sort_array(tags), seed, key, slot), F.lit(V.DEFAULT_TAG))
