"""Output shaping and writers."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import empty_int_array

RECORD_SCHEMA = ("id BIGINT, image STRING, text STRING, fake_cls STRING, fake_image_box ARRAY<INT>, "
                 "fake_text_pos ARRAY<INT>, mtcnn_boxes ARRAY<ARRAY<INT>>")
RECORD_COLUMNS = ["id", "image", "text", "fake_cls", "fake_image_box", "fake_text_pos", "mtcnn_boxes"]


def normalise_path(p: Column) -> Column:
    """Backslashes to forward slashes."""
    return F.replace(p, F.lit("\\"), F.lit("/"))


def image_path(bucket: Column, id_col: Column, seed) -> Column:
    """<bucket dir>/<32 hex chars>.jpg: the whole digest of (seed, id), so names stay apart at any size."""
    dirs = F.create_map(*[x for k, v in V.BUCKET_DIR.items() for x in (F.lit(k), F.lit(v))])
    name = F.md5(F.concat_ws("|", F.lit(str(seed)), id_col.cast("string"), F.lit("img")))
    return F.concat(F.element_at(dirs, bucket), F.lit("/"), name, F.lit(".jpg"))


def make_records(df: DataFrame) -> DataFrame:
    """The sample record with empty-list defaults and a fixed schema.

    Expects ``id, image, text, fake_cls`` and optionally ``fake_text_pos``,
    ``mtcnn_boxes``, ``fake_image_box``."""
    def opt(name, empty):
        return F.coalesce(F.col(name), empty) if name in df.columns else empty
    return df.select(
        F.col("id").cast("bigint").alias("id"),
        normalise_path(F.col("image")).alias("image"),
        F.col("text"),
        F.col("fake_cls"),
        opt("fake_image_box", empty_int_array()).alias("fake_image_box"),
        opt("fake_text_pos", empty_int_array()).alias("fake_text_pos"),
        opt("mtcnn_boxes", F.array().cast("array<array<int>>")).alias("mtcnn_boxes"),
    )


def append_jsonl(df: DataFrame, path: str) -> None:
    """B1: append one JSON object per line (UTF-8; non-ASCII kept)."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_snapshot(df: DataFrame, path: str, version: int | None = None) -> str:
    """B2: full snapshot, overwritten; versioned sub-folder when given. Every task writes its own file."""
    out = os.path.join(path, f"version={version}") if version is not None else path
    df.write.mode("overwrite").json(out)
    return out


def write_partitioned(df: DataFrame, path: str, col: str = "fake_cls", fmt: str = "parquet") -> None:
    """Route rows to one directory per class. No shuffle by class: each task writes its share of every class."""
    df.write.mode("overwrite").partitionBy(col).format(fmt).save(path)


def write_classification(df: DataFrame, path: str) -> None:
    """Classification.csv with header (id,label,confidence,manipulation_type)."""
    (df.select("id", "label", "confidence", "manipulation_type")
     .write.mode("overwrite").option("header", True).csv(path))


def grounding_lines(df: DataFrame, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """One ``{"id": [..]}`` object per row."""
    return df.select(F.to_json(F.create_map(F.col(id_col).cast("string"), F.col(tokens_col))).alias("json"))
