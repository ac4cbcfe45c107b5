"""Keyword join (F2, A8): which keywords does a text contain, for keyword tables of any size.

``contains`` against a table is a nested loop. Here every keyword is represented by one of
its q-grams, the one that fewest texts hold; a text that contains the keyword contains that
gram, so an equi-join of the texts' grams with the keywords' grams finds every candidate,
and ``contains`` on the candidates decides. Neither side is broadcast by this code; the
planner may do so when it measures one to be small.

* Only grams that some keyword has are kept of a text, and each once, before anything is
  joined, and only their numbers are shuffled, with the row's key; texts come back for the
  candidates alone. Grams are made in Arrow batches, by shifting the array of code points.
* Keywords that are shorter than q are their own gram, of their own length.
* Counting how many texts hold a gram only steers which gram stands for a keyword. It
  never changes the result.

Both sides are compared in lower case. Null texts contain nothing, null and empty keywords
are left out, a repeated keyword counts once (with each of its tags). The key of a text
must be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

Q = 3


def _grams(text: str, q: int):
    """The distinct q-grams of a text as numbers: the code points, 21 bits each (the last three of
    longer grams, which makes more candidates and no other result)."""
    import numpy as np

    x = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    n = max(0, len(x) - q + 1)
    g = np.zeros(n, np.int64)
    for i in range(q):
        g = (g << 21) | x[i:i + n]
    return np.unique(g)


def explode_grams(df: DataFrame, key: str, text_col: str, lengths: list[int], own: bool = False) -> DataFrame:
    """key, g: the grams of each of the ``lengths`` of every text; if ``own``, only those of the
    largest length that the text has. Null texts have none."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 128):  # texts can be long
                part = b.slice(at, 128)
                found = []
                for t in part.column(1).to_pylist():
                    sizes = [max((q for q in lengths if q <= len(t)), default=1)] if own else lengths
                    found.append(np.concatenate([_grams(t, q) for q in sizes]))
                of = np.repeat(np.arange(len(found)), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of)), pa.array(np.concatenate(found))], ["key", "g"])

    kind = df.schema[key].dataType.simpleString()
    d = df.filter(F.col(text_col).isNotNull()).select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, f"key {kind}, g long").withColumnRenamed("key", key)


def _anchors(words: DataFrame, text_grams: DataFrame, q: int) -> DataFrame:
    """word, g: the gram that stands for each keyword."""
    own = explode_grams(words.withColumn("_w", F.col("word")), "word", "_w", list(range(1, q + 1)), own=True)
    held = text_grams.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    rated = own.join(held, "g")  # a gram that no text holds: neither does any text hold the keyword
    total = own.groupBy("word").agg(F.count(F.lit(1)).alias("all"))
    best = rated.groupBy("word").agg(F.min(F.struct("n", "g")).alias("r"), F.count(F.lit(1)).alias("found"))
    return best.join(total, "word").filter("found = all").select("word", F.col("r.g").alias("g"))


def keyword_join(texts: DataFrame, keywords: DataFrame, key: str = "id", text_col: str = "text", word_col: str = "keyword", q: int = Q) -> DataFrame:
    """key and the columns of ``keywords``, for every keyword that the text contains."""
    k = keywords.withColumn("word", F.lower(word_col)).filter(F.coalesce(F.col("word") != "", F.lit(False)))
    words = cut_lineage(k.select("word").distinct())
    t = texts.filter(F.col(text_col).isNotNull()).select(F.col(key).alias("_key"), F.lower(text_col).alias("_text"))
    lengths = sorted(r[0] for r in words.select(F.least(F.length("word"), F.lit(q))).distinct().collect())  # q numbers at most
    if not lengths:
        return texts.limit(0).select(key).join(keywords.limit(0))
    wanted = explode_grams(words.withColumn("_w", F.col("word")), "word", "_w", list(range(1, q + 1)), own=True).select("g").distinct()
    held = explode_grams(t, "_key", "_text", lengths).join(wanted, "g", "left_semi")
    held = cut_lineage(held)
    candidates = held.join(_anchors(words, held, q), "g").select("_key", "word")
    found = t.join(candidates, "_key").filter(F.contains("_text", "word")).select(F.col("_key").alias(key), "word")
    return found.join(k, "word").drop("word")
