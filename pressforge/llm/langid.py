"""Language identification: nearest of several clustered centroids per language.

A text becomes the TF-IDF vector of its character 1- to 3-grams, hashed into
DIM buckets and normalised. Document frequencies come from every training row.
Each language's centroids are a spherical k-means over a bounded sample of its
distinct texts (``sample`` per language). A text gets the language of the centroid with
the highest cosine; one whose distance from it is far beyond that of training
texts of similar length is marked ``rejected``.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected. Without any training row nothing is learned, and every text is ``und``
but not rejected for that reason. Ties go to the alphabetically first language.
Repeated rows are predicted alike, one result for each. Columns other than
doc_id, text and lang are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, small_batches

DIM = 4096
SLICE = 1 << 20  # characters counted at a time
MAX_LANGS = 1000


def letter_table():
    """Code point -> is it a letter (of the basic plane; the rest asks Python)."""
    return np.fromiter((chr(i).isalpha() for i in range(0x10000)), dtype=bool, count=0x10000)


def gram_counts(text: str, letters) -> np.ndarray:
    """Counts of hashed character 1- to 3-grams; runs of non-letters are word ends."""
    total = np.zeros(DIM, dtype=np.int64)
    text = text.lower()
    for at in range(0, len(text), SLICE):
        # two characters before the slice, so that no gram is lost between slices
        x = np.frombuffer(text[max(0, at - 2):at + SLICE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        big = x >= 0x10000
        ok = letters[np.where(big, 0, x)]
        if big.any():
            ok = ok | np.fromiter((chr(c).isalpha() for c in x), dtype=bool, count=len(x))
        x = np.where(ok, x, 0).astype(np.uint64)
        skip = min(at, 2)
        one = x
        two = x[1:] * np.uint64(0x9E3779B1) + x[:-1] * np.uint64(0x85EBCA77)
        three = x[2:] * np.uint64(0xC2B2AE3D) + x[1:-1] * np.uint64(0x27D4EB2F) + x[:-2] * np.uint64(0x165667B1)
        # a gram belongs to the slice that holds its last character; none is blank twice in a row
        for n, h, keep in ((1, one[skip:], ok[skip:]),
                           (2, two[max(0, skip - 1):], (ok[1:] | ok[:-1])[max(0, skip - 1):]),
                           (3, three[max(0, skip - 2):], (ok[1:-1] | (ok[2:] & ok[:-2]))[max(0, skip - 2):])):
            h = h[keep]
            if len(h):
                h = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                total += np.bincount((h >> np.uint64(52)).astype(np.int64), minlength=DIM)
    return total


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts).astype(np.float32) * idf
    n = float(np.sqrt(np.dot(v, v)))
    return v / np.float32(n) if n else v


def band(counts: np.ndarray) -> int:
    """Length band: log2 of the number of grams."""
    return int(counts.sum()).bit_length()


ENOUGH, MARGIN = 20, 0.6  # texts that a length band's threshold needs; its part of their lowest cosine


def thresholds(cos: np.ndarray, bands: np.ndarray) -> list[float]:
    """Least cosine of each length band: the lowest of its training texts, less a margin. A band with
    too few looks at its neighbours too. Longer texts only get closer to their centroid; cosines
    taken from longer ones are lowered by the square root of the length. A language with fewer than
    ENOUGH texts rejects nothing."""
    if len(cos) < ENOUGH:
        return [0.0] * 64
    low = []
    for j in range(64):
        away = np.abs(bands - j)
        near = away <= np.sort(away)[ENOUGH - 1]
        low.append(float((cos[near] * 2.0 ** (-0.5 * np.maximum(0, bands[near] - j))).min() * MARGIN))
    return low


def document_frequencies(train: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and rows with each gram bucket, over all training texts (DIM + 1 numbers)."""
    def count(batches):
        letters, df, n = letter_table(), np.zeros(DIM, dtype=np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                df += gram_counts(text, letters) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, DIM), pa.int32()), pa.array([n, *df.tolist()], pa.int64())],
                                         names=["bucket", "n"])

    got = {r.bucket: r.n for r in train.select("text").mapInArrow(count, "bucket int, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    return got.get(-1, 0), np.array([got.get(i, 0) for i in range(DIM)], dtype=np.int64)


def fit(train: DataFrame, sample: int = 1500, clusters: int = 4, rounds: int = 8) -> dict | None:
    """train: text, lang (neither null). The model is bounded: at most MAX_LANGS
    languages, ``clusters`` vectors of DIM floats each."""
    hashed = train.select("lang", "text", F.xxhash64("text").alias("h"))
    langs = {r.lang: r.n for r in hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if not langs:
        return None
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    n, df = document_frequencies(train)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # about 1.3 * sample distinct texts of each language, by their hash; all of them where there are fewer
    rate = F.create_map(*[F.lit(x) for k, v in langs.items() for x in (k, int(min(1.0, 1.3 * sample / v) * (1 << 30)))])
    chosen = (hashed.filter(F.pmod("h", F.lit(1 << 30)) < rate[F.col("lang")])
              .groupBy("lang", "h").agg(F.first("text").alias("text")))

    def centroids(pdf):
        letters = letter_table()
        pdf = pdf.sort_values(["h", "text"]).head(sample)
        counts = [gram_counts(t, letters) for t in pdf["text"]]
        x = np.stack([weigh(c, idf) for c in counts])
        rng, k = np.random.default_rng(7), min(clusters, len(x))
        at = [int(rng.integers(len(x)))]
        while len(at) < k:  # the farthest text from those chosen is the next seed
            at.append(int(np.argmin((x @ x[at].T).max(axis=1))))
        c = x[at]
        for _ in range(rounds):
            own = np.argmax(x @ c.T, axis=1)
            c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(k)])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        cos, bands = (x @ c.T).max(axis=1), np.array([band(t) for t in counts])
        low = thresholds(cos, bands)
        return __import__("pandas").DataFrame({"lang": [pdf["lang"].iloc[0]], "c": [c.astype(np.float32).tobytes()], "low": [low]})

    rows = sorted(chosen.groupBy("lang").applyInPandas(centroids, "lang string, c binary, low array<double>").collect(),
                  key=lambda r: r.lang)
    c = [np.frombuffer(r.c, dtype=np.float32).reshape(-1, DIM) for r in rows]
    return {"langs": [r.lang for r in rows], "idf": idf, "c": np.concatenate(c),
            "of": np.repeat(np.arange(len(c)), [len(x) for x in c]), "low": np.array([r.low for r in rows])}


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """docs' columns but the last, which is the text, then lang_pred, score (cosine) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])

    def run(batches):
        letters, m = letter_table(), shared.value
        for b in batches:
            lang, score, rejected = [], [], []
            for text in b.column(b.num_columns - 1).to_pylist():
                counts = gram_counts(text, letters) if text else None
                if counts is None or not counts.any():
                    one = ("und", 0.0, True)
                elif m is None:
                    one = ("und", 0.0, False)
                else:
                    cos = m["c"] @ weigh(counts, m["idf"])
                    j = int(np.argmax(cos))
                    one = (m["langs"][m["of"][j]], float(min(1.0, max(0.0, cos[j]))), bool(cos[j] < m["low"][m["of"][j], band(counts)]))
                for col, v in zip((lang, score, rejected), one):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                                             names=schema.names)

    return docs.mapInArrow(run, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter((fold("doc_id", 3) != 1) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")


def identify(docs: DataFrame, sample: int = 1500, clusters: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of docs."""
    docs = small_batches(docs).select("doc_id", "text", "lang")
    model = fit(training_rows(docs), sample, clusters)
    return predict(docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text"), model)


def keep_known(docs: DataFrame, sample: int = 1500, clusters: int = 4) -> DataFrame:
    """The rows of docs that are not rejected, with their own columns."""
    model = fit(training_rows(small_batches(docs)), sample, clusters)
    return predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), model).filter(~F.col("rejected")).select("row.*")
