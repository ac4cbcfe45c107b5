"""A training corpus from raw documents: five stages, each written as Parquet before the next.

Language ID drops what it rejects; of each group of near copies one document
stays; documents that share a passage with the benchmark go; personal data is
replaced; what is left is tokenised and packed. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pressforge.llm import decontam, langid, ngram_join, packing, pii
from pressforge.llm.common import table
from pressforge.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("ngram_jaccard", near_duplicates), ("decontamination", decontamination),
          ("pii", personal_data), ("best_fit_packing", best_fit_packing)]

#: Tokenisation and clustering have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
