"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs and pairs with one word
left out, hashed into 2^BITS places. Training rows are a bounded sample of the
labelled ones (about ``sample`` per label), small enough for one task, which runs
FTRL-proximal (a learning rate per coordinate, L1 sparsity) for some epochs. The task
holds four bytes a feature of the sample: a text has as many as three times its distinct
words, 2^BITS (4 MB) at most. Only
non-zero weights remain (at most 2^BITS), so they can be broadcast.

Edge cases: a null or empty text has no feature and gets the bias alone. With no
label of one kind nothing is learned: every score is the share of label 1, or 0
without labels. Repeated labels of a document count once, toxic if any is;
repeated documents are scored alike, one result for each. Columns other than
doc_id and text (labels: doc_id, toxic) are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, fold, mix64, small_batches, text_bytes

BITS = 20
SPAN = 1 << 18  # words hashed at a time


def feature_slices(text: bytes, words: WordHashes):
    """Hashed features of a text, some at a time; a slice overlaps the last by two words."""
    import re

    ws = re.findall(rb"[0-9a-z\x80-\xff]+", text.lower())
    for at in range(0, max(1, len(ws)), SPAN):
        h = words.of(ws[max(0, at - 2):at + SPAN])
        parts = [h, h[:-1] * np.uint64(3) + h[1:] * np.uint64(5), h[:-2] * np.uint64(7) + h[2:] * np.uint64(11)]
        yield (mix64(np.concatenate(parts)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: bytes, words: WordHashes) -> np.ndarray:
    return np.unique(np.concatenate(list(feature_slices(text, words))))


def ftrl(rows: list[np.ndarray], y: np.ndarray, epochs: int = 8, alpha: float = 2.0, beta: float = 1.0,
         l1: float = 8.0, l2: float = 0.1):
    """Weights and bias. Place 2^BITS is the bias, without L1."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = np.array([1 << BITS])

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[np.abs(zi) <= l1] = 0.0
        w[-1] = -zi[-1] / ((beta + np.sqrt(n[i[-1]])) / alpha)
        return w

    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            i = np.concatenate([rows[r], bias])
            w = weight(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y[r]
            root = np.sqrt(n[i])
            z[i] += g - (np.sqrt(n[i] + g * g) - root) / alpha * w
            n[i] += g * g
    every = np.concatenate([np.flatnonzero(np.abs(z[:-1]) > l1), bias])
    return every, weight(every)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> dict:
    """Weights from a sample of about ``sample`` documents of each label."""
    spark = docs.sparkSession
    marks = (labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold("doc_id", 5) != 0))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y")))
    n = {r.y: r.n for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        share = 1.0 if n.get(1) else 0.0
        return {"i": np.zeros(0, dtype=np.int64), "w": np.zeros(0), "bias": 30.0 if share else -30.0}
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rate = F.when(F.col("y") == 1, F.lit(int(min(1.0, sample / n[1]) * (1 << 30)))).otherwise(F.lit(int(min(1.0, sample / n[0]) * (1 << 30))))
    chosen = marks.filter(u < rate)
    # about 2 * sample ids: counted, and sent to the texts, so that only sampled texts are shuffled
    if chosen.count() <= 8 * sample:
        chosen = F.broadcast(chosen)
    # a document that is there more than once counts once, with its smallest text
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).select("text", "y")

    def featurise(batches):
        words = WordHashes()
        for b in batches:
            f = [features(t, words).astype("<i4").tobytes() for t in text_bytes(b)]
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(f, pa.binary())], names=["y", "f"])

    def train(pdf):
        import pandas as pd

        rows = [np.frombuffer(f, dtype="<i4") for f in pdf["f"]]
        y = pdf["y"].to_numpy(dtype=float)
        order = sorted(range(len(rows)), key=lambda r: (len(rows[r]), int(rows[r].sum(dtype=np.int64)), y[r], rows[r].tobytes()))
        i, w = ftrl([rows[r] for r in order], y[order])
        return pd.DataFrame({"i": i, "w": w})

    got = rows.mapInArrow(featurise, "y int, f binary").groupBy().applyInPandas(train, "i long, w double").collect()
    i, w = np.array([r.i for r in got], dtype=np.int64), np.array([r.w for r in got])
    return {"i": i[i < 1 << BITS], "w": w[i < 1 << BITS], "bias": float(w[i == 1 << BITS].sum())}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, words = shared.value, WordHashes()
        dense = np.zeros(1 << BITS)
        dense[m["i"]] = m["w"]
        for b in batches:
            out = []
            for text in text_bytes(b):
                hit = [f[dense[f] != 0] for f in feature_slices(text, words)]
                s = dense[np.unique(np.concatenate(hit))].sum() + m["bias"]
                out.append(1.0 / (1.0 + np.exp(-np.clip(s, -35, 35))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.float64()), pa.array([int(x >= 0.5) for x in out], pa.int32())],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def classify(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> DataFrame:
    return score(docs, fit(small_batches(docs), labels, sample))
