"""The operators as queries over the given tables."""

from __future__ import annotations

import corpus_pipeline

from . import centroids, chat, decontam, divergence, langid, lm, ngram_join, packing, pii, quality, substring, suffix, toxicity
from .common import table
from .oracle import ORACLE  # noqa: F401 - read by the entry module

QUERIES = {
    "op1_substring_dedup": lambda s, d: substring.dedup(table(s, d, "documents"), stretch_words=15),
    "op2_quality_rules": lambda s, d: quality.clean(table(s, d, "documents")).drop("clean_text"),
    "op3_best_fit_packing": lambda s, d: packing.pack(table(s, d, "documents")),
    "op4_pii": lambda s, d: pii.report(table(s, d, "documents")),
    "op5_toxicity": lambda s, d: toxicity.classify(table(s, d, "documents"), table(s, d, "labels")),
    "op6_lm_scoring": lambda s, d: lm.evaluate(table(s, d, "documents")),
    "op7_language_id": lambda s, d: langid.identify(table(s, d, "documents")),
    "op8_suffix_dedup": lambda s, d: suffix.dedup(table(s, d, "documents")).drop("kept"),
    "op9_decontamination": lambda s, d: decontam.report(table(s, d, "documents"), table(s, d, "benchmark")),
    "op10_ngram_jaccard": lambda s, d: ngram_join.join(table(s, d, "documents")),
    "op11_chat_format": lambda s, d: chat.formatted(table(s, d, "conversations")),
    "op12_centroid_clustering": lambda s, d: centroids.digests(table(s, d, "embeddings")),
    "op13_source_divergence": lambda s, d: divergence.audit(table(s, d, "documents")),
    "pipeline": corpus_pipeline.run,
}
