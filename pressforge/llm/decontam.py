"""Benchmark decontamination by winnowing, with native columns.

Words are hashed in k-grams; of every window of SPAN words only the k-gram with
the smallest hash is kept (the first of equal ones). A passage of SPAN or more
words that a document shares with an item therefore has a common fingerprint in
each of its windows. Document fingerprints are joined with the items', and each
hit is extended word by word to both sides, which decides exactly what is shared.

An item shorter than SPAN words is one window; documents get fingerprints for
each such length that occurs (at most SPAN - 1 of them).

Edge cases: a null or empty text has no words, is not contaminated and its items
hash is that of "". Items without words match nothing. Repeated items count by
item_id, so once; repeated documents give one result each. Extra columns are not
looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_ascii, row_key

SPAN, GRAM = 10, 5
POS_BITS = 28
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), lambda w: w != "")


def fingerprints(words: Column, span: int) -> Column:
    """Kept k-grams of a text's windows of ``span`` words: hash bits above, word position below."""
    k, low = min(GRAM, span), (1 << POS_BITS) - 1

    def grams(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(
            *[F.get(w, i + j) for j in range(k)]).bitwiseAND(~low).bitwiseOR(i.cast("long")))

    def least(g: Column) -> Column:
        if span == k:
            return g
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(g) - (span - k)), lambda i: F.array_min(F.slice(g, i, span - k + 1))))

    return F.when(F.size(words) >= span, let(grams(words), least))


def context(words: Column, pos: Column, span: int) -> Column:
    """The words that can share a window of ``span`` words with the k-gram at ``pos``; null beyond the text."""
    k = min(GRAM, span)
    return F.array(*[F.get(words, pos + j) for j in range(k - span, span)])


def fingerprint_rows(rows: DataFrame, keep: list[str], span: int) -> DataFrame:
    """keep columns, h, pos of each fingerprint; ``text`` is read."""
    fp = let(words_of(F.col("text")), lambda w: fingerprints(w, span))
    return (rows.select(*keep, F.explode(fp).alias("fp"))
            .select(*keep, F.shiftright("fp", POS_BITS).alias("h"), F.col("fp").bitwiseAND((1 << POS_BITS) - 1).cast("int").alias("pos")))


def shared_runs(docs: DataFrame, items: DataFrame, span: int) -> DataFrame:
    """k1, k2, item_id, lo, hi: document words lo..hi-1 are shared with the item, hi - lo >= span."""
    k, side = min(GRAM, span), span - min(GRAM, span)
    source = (items.select("item_id", "text", let(words_of(F.col("text")), lambda w: F.when(
        (F.size(w) >= span) if span == SPAN else (F.size(w) == span), let(fingerprints(w, span), lambda fp: F.transform(fp, lambda x: F.struct(
            F.shiftright(x, POS_BITS).alias("h"), context(w, x.bitwiseAND((1 << POS_BITS) - 1).cast("int"), span).alias("ctx")))))).alias("fp"))
        .select("item_id", F.explode("fp").alias("fp")).select("item_id", "fp.h", F.col("fp.ctx").alias("there")).distinct())
    met = fingerprint_rows(docs, ["k1", "k2"], span).join(source.select("h").distinct(), "h", "left_semi")
    places = met.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("pos", "h"))).alias("places"))
    # the text of documents with a met fingerprint is read once more, for the words around
    around = (docs.join(places, ["k1", "k2"]).select("k1", "k2", F.explode(let(words_of(F.col("text")), lambda w: F.transform(
        F.col("places"), lambda p: F.struct(p["h"].alias("h"), p["pos"].alias("pos"), context(w, p["pos"], span).alias("here"))))).alias("p"))
        .select("k1", "k2", "p.h", "p.pos", "p.here").distinct())
    both = around.join(source, "h")

    def equal(j: int) -> Column:  # j: place relative to the k-gram
        return F.coalesce(F.get("here", F.lit(j + side)) == F.get("there", F.lit(j + side)), F.lit(False))

    def run(js) -> Column:  # words in a row that are equal
        js = list(js)
        return reduce(lambda far, nj: F.when(~equal(nj[1]), F.lit(nj[0])).otherwise(far), list(enumerate(js))[::-1], F.lit(len(js)))

    left, right = run(range(-1, -side - 1, -1)), run(range(k, k + side))
    same = reduce(lambda a, b: a & b, [equal(j) for j in range(k)])
    return (both.filter(same).select("k1", "k2", "item_id", (F.col("pos") - left).alias("lo"), (F.col("pos") + k + right).alias("hi"))
            .filter(F.col("hi") - F.col("lo") >= span).distinct())


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs' rows (doc_id, text, k1, k2) with n_words, n_hit, n_items, items_sha256, contaminated."""
    docs, items = row_key(docs.select("doc_id", "text")), benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    size = F.regexp_count(F.col("text"), F.lit(WORD))
    short = [r.n for r in items.select(size.alias("n")).filter((F.col("n") > 0) & (F.col("n") < SPAN)).distinct().orderBy("n").collect()]  # < SPAN rows
    runs = reduce(DataFrame.unionByName, [shared_runs(docs, items, s) for s in [SPAN, *short]])
    named = runs.select("k1", "k2", F.col("item_id").cast("string").alias("item"), "lo", "hi").distinct()
    of_items = (named.groupBy("k1", "k2", "item").agg(F.count("*"))
                .groupBy("k1", "k2").agg(F.count("item").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items")))
    hits = (named.select("k1", "k2", "lo", "hi").distinct().select("k1", "k2", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("pos"))
            .distinct().groupBy("k1", "k2").agg(F.count("*").alias("n_hit")))
    found = hits.join(of_items, ["k1", "k2"])
    zero = F.lit(0).cast("long")
    return (docs.select("doc_id", "k1", "k2", F.coalesce(size.cast("long"), zero).alias("n_words")).join(found, ["k1", "k2"], "left")
            .select("doc_id", "k1", "k2", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
                    F.coalesce("items", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated")))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find(docs, benchmark).drop("k1", "k2")


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that share nothing with the benchmark, with their own columns."""
    hit = find(docs, benchmark).filter("contaminated").select("k1", "k2").distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    return row_key(keyed).join(hit, ["k1", "k2"], "left_anti").select("row.*")
