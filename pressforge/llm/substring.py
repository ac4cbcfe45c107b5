"""Substring dedup over sliding sentence spans.

Every run of ``span`` consecutive sentences is hashed (white space and A-Z case
put aside). The hashes are grouped over the whole corpus; of each one that occurs
more than once, the first place stays (lowest doc_id, then position), and the
sentences under every other place are removed.

A text with fewer sentences than ``span`` is one run. Runs of fewer than
``min_words`` words are let be: such phrases recur by chance.

With ``stretch_words`` every run is hashed, whatever its words, and the minimum is
asked of the stretch of sentences that such runs cover without a gap, whichever
documents hold their first places: a stretch of fewer words is let be (two short
sentences meet by chance). A sentence of ``stretch_words`` words is a span of its own,
and so is a whole text: of one that repeats another sentence by sentence nothing stays.

Edge cases: a null text counts as empty (clean text ""). Rows that repeat both
doc_id and text are one document: all stay or lose the same. Null ids come first.
Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressforge.session import cut_lineage

from .common import as_long, mix64, row_key, small_batches, text_bytes

CJK = "(?:{})(?:{})*".format("|".join("。！？｡"), "|".join("」』”’）】")).encode()  # no blank need follow these
BOUNDARY = re.compile(rb"[.!?][\"')\]]*[\x20\x09-\x0D]+|\n|" + CJK + rb"[\x20\x09-\x0D]*")
WHOLE, ALONE = -1, 1 << 30  # places of whole texts, and (added to the place) of single sentences


def sentences(text: bytes) -> list[tuple[int, int, bytes, int]]:
    """start, end, normal form and words of each sentence; blank stretches are none."""
    out, at = [], 0
    for end in [*(m.end() for m in BOUNDARY.finditer(text)), len(text)]:
        words = text[at:end].lower().split()
        if words:
            out.append((at, end, b" ".join(words), len(words)))
        at = end
    return out


def runs(found: list, span: int, min_words: int, stretch_words: int | None = None):
    """Positions and hashes of the runs of a text's sentences."""
    import xxhash

    n = len(found)
    h = np.fromiter((xxhash.xxh3_64_intdigest(s[2]) for s in found), dtype=np.uint64, count=n)
    w = np.concatenate([[0], np.cumsum([s[3] for s in found])]) if n else np.zeros(1)
    k = min(span, n)
    if not k:
        return np.zeros(0, dtype=np.int32), h
    total = np.zeros(n - k + 1, dtype=np.uint64)
    for j in range(k):
        total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + h[j:n - k + 1 + j])
    if stretch_words is not None:
        alone = np.flatnonzero(np.diff(w) >= stretch_words)
        whole = np.uint64(xxhash.xxh3_64_intdigest(b"whole" + h.tobytes()))
        pos, total = (np.arange(len(total)), total) if n >= span else (np.zeros(0, dtype=np.int64), h[:0])
        return (np.concatenate([[WHOLE], pos, alone + ALONE]).astype(np.int32),
                np.concatenate([[whole], total, mix64(h[alone] + np.uint64(1))]).astype(np.uint64))
    long = np.flatnonzero(w[k:] - w[:-k] >= min_words)
    return long.astype(np.int32), total[long]


def stretches(found: list, pos: list, span: int, least: int) -> set:
    """Sentences to remove. Runs at ``pos`` (in order) have an earlier place somewhere; runs that
    follow one another cover a stretch, and stretches of at least ``least`` words go."""
    if pos and pos[0] == WHOLE:
        return set(range(len(found)))
    w = np.concatenate([[0], np.cumsum([s[3] for s in found])])
    out, begin, last = {p - ALONE for p in pos if p >= ALONE}, None, None

    def close():
        if begin is not None and w[last + span] - w[begin] >= least:
            out.update(range(begin, last + span))

    for p in pos:
        if p >= ALONE:
            break
        if last is None or p > last + span:  # a sentence between them is under no run
            close()
            begin = p
        last = p
    close()
    return out


def span_rows(docs: DataFrame, span: int, min_words: int, stretch_words: int | None = None) -> DataFrame:
    """doc_id, k1, pos, h: one row per run."""
    def run(batches):
        for b in batches:
            ids, k1 = b.column(0), b.column(1)
            for at in range(0, b.num_rows, 512):
                found = [runs(sentences(t), span, min_words, stretch_words) for t in text_bytes(b.slice(at, 512))]
                own = pa.array(np.repeat(np.arange(at, at + len(found)), [len(p) for p, _ in found]))
                yield pa.RecordBatch.from_arrays([ids.take(own), k1.take(own), pa.array(np.concatenate([p for p, _ in found])),
                                                  pa.array(as_long(np.concatenate([h for _, h in found])))], names=["doc_id", "k1", "pos", "h"])

    return row_key(docs).select("doc_id", "k1", "text").mapInArrow(run, "doc_id long, k1 long, pos int, h long")


def dedup(docs: DataFrame, span: int = 2, min_words: int = 15, stretch_words: int | None = None) -> DataFrame:
    """doc_id, n_sentences, n_removed, clean_text for every row of docs. With ``stretch_words``,
    ``min_words`` isn't looked at."""
    docs = small_batches(docs).select("doc_id", "text")
    rows = span_rows(docs, span, min_words, stretch_words)
    place = F.struct("doc_id", "k1", "pos")
    # a table of its own, so that the join below may split a hash that very many documents share
    first = cut_lineage(rows.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last").select("h", "first"))
    gone = (rows.join(first, "h").filter(place != F.col("first")).groupBy("k1", "doc_id")
            .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
            .select("k1", F.col("doc_id").alias("of"), "gone"))
    keyed = row_key(docs).select("doc_id", "k1", "text")
    joined = keyed.join(gone, (keyed.k1 == gone.k1) & keyed.doc_id.eqNullSafe(gone.of), "left").select("doc_id", "text", "gone")

    def cut(batches):
        for b in batches:
            total, lost, texts = [], [], []
            for t, gone in zip(text_bytes(b), b.column(2)):
                found = sentences(t)
                pos = gone.values.to_pylist() if gone.is_valid else ()
                if stretch_words is None:
                    under = sorted({p + j for p in pos for j in range(span) if p + j < len(found)})
                else:
                    under = sorted(stretches(found, pos, span, stretch_words)) if pos else []
                at, kept = 0, []
                for i in under:
                    kept.append(t[at:found[i][0]])
                    at = found[i][1]
                total.append(len(found))
                lost.append(len(under))
                texts.append((b"".join(kept) + t[at:]).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_sentences", "n_removed", "clean_text"])

    return joined.mapInArrow(cut, "doc_id long, n_sentences long, n_removed long, clean_text string")
