"""Source divergence audit: a recount of the frequent terms through minimal perfect hashes.

1. **Exact document frequency.** Tasks count in how many of their documents each (lang,
   term) occurs, in a table of bounded size that is emptied when full; Spark adds up.
   Terms in at least ``min_docs`` documents of a lang are kept.
2. **Minimal perfect hashes.** The kept terms of all langs are cut into shards by hash. One
   task a shard places its n keys in n slots without collision (buckets of about four keys,
   largest first, each with the first displacement that finds its keys free slots). A shard
   holds the displacements and, by slot, the keys themselves: a looked-up term counts only
   if the key stored at its slot equals it.
3. **Recount.** The shards are broadcast. The second pass looks up the terms of every text
   and increments the slot of its term in the dense array of the text's (lang, source).
   Arrays are emptied when a task holds too many slots, so its memory is bounded whatever
   the number of groups. Spark adds up (lang, source, term).
4. Shares are integers: ``p = 1 + floor(10^9 (count + a) / (N + a V))`` in exact decimals.
   Differences between sources are summed shard by shard: a task holds the sources by terms
   matrix of some 1,024 terms and two blocks of sources, with the share of count 0 where a
   source doesn't have a term. Only sums leave it.

What is broadcast is bounded by ``slots`` keys of at most KEY_BYTES bytes. The document
frequency from which a key is among them is read off a histogram of 64 numbers; should
there be more kept terms, the recount of the rarer (and of longer) ones is a join on the
term instead, in the same pass and with the same result (tested with few slots).

Results for odd rows: null text, lang and source read as ''. A text without terms adds
nothing, but its (lang, source) is still a group. A lang without kept terms has V = 0: its
sources differ by 0, its term part is empty. A lang with one source has no pair part. An
empty table gives no rows. Repeated rows are documents each. Very long texts are one list
of words in one task. Ties in value are ranked by the item's UTF-8 bytes. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressforge.session import cut_lineage

from .common import MASK64, small_batches, text_bytes

# bytes that are no part of a term become spaces, A-Z become a-z; bytes from 0x80 on are letters
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
KEY_BYTES = 64  # longer terms are never broadcast
ENTRIES = 1 << 18  # counts that a task holds before it hands them on
SHARD_KEYS = 4096
MATRIX_TERMS = 1024
SOURCE_BLOCK = 256
ONE = 1_000_000_000


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def read(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return small_batches(docs).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), ("lang", "lang"), ("source", "source"))])


def document_frequency(docs: DataFrame) -> DataFrame:
    """lang, term, df: documents of the lang that hold the term."""
    def run(batches):
        from collections import Counter, defaultdict

        import pyarrow as pa

        def rows():
            langs = [x for x, c in held.items() for _ in range(len(c))]
            out = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([t.decode() for c in held.values() for t in c], pa.string()),
                                              pa.array([n for c in held.values() for n in c.values()], pa.int64())], ["lang", "term", "df"])
            held.clear()
            return out

        held, n = defaultdict(Counter), 0
        for b in batches:
            for lang, text in zip(b.column(1).to_pylist(), text_bytes(b)):
                words = set(terms(text))
                n += len(words)  # at least as many as are new
                held[lang].update(words)
                if n >= ENTRIES:
                    n = sum(map(len, held.values()))
                    if n >= ENTRIES // 2:
                        yield rows()
                        n = 0
        yield rows()

    parts = docs.select("text", "lang").mapInArrow(run, "lang string, term string, df long")
    return parts.groupBy("lang", "term").agg(F.sum("df").alias("df"))


# --- minimal perfect hashes ---------------------------------------------------------

def key_hash(key: bytes, seed: int = 0) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(key, seed)


def shard_of(h: int, shards: int) -> int:
    return (h >> 40) % shards


def slot_of(h: int, displacement: int, n: int) -> int:
    """The slot of a hash among n under a displacement: one multiply-shift round."""
    x = ((h ^ displacement * 0x9E3779B97F4A7C15) & MASK64) * 0xD6E8FEB86659FD93 & MASK64
    return (x ^ x >> 32) % n


def build(keys: list[bytes]) -> tuple[int, list[int], list[bytes]]:
    """Seed of the hash, displacements by bucket and the keys by slot; ``keys`` are distinct."""
    n, buckets, seed = len(keys), max(1, -(-len(keys) // 4)), 0
    hashes = {k: key_hash(k) for k in keys}
    while len(set(hashes.values())) < n:  # two keys share all 64 bits
        seed += 1
        hashes = {k: key_hash(k, seed) for k in keys}
    members: list[list[bytes]] = [[] for _ in range(buckets)]
    for k in keys:
        members[hashes[k] % buckets].append(k)
    at, slots = [0] * buckets, [b""] * n
    free = [True] * n
    for b in sorted(range(buckets), key=lambda i: (-len(members[i]), i)):
        if not members[b]:
            break
        d = 0
        while True:
            want = [slot_of(hashes[k], d, n) for k in members[b]]
            if all(free[w] for w in want) and len(set(want)) == len(want):
                break
            d += 1
        at[b] = d
        for k, w in zip(members[b], want):
            slots[w], free[w] = k, False
    return seed, at, slots


class Slots(dict):
    """Key -> its place among all keys of all shards, or -1; the answers for the terms
    met most often are remembered (up to LIMIT of them)."""

    LIMIT = 200_000

    def __init__(self, shards):
        self.shards, self.first, self.size = shards, [], 0
        for *_, keys in shards:
            self.first.append(self.size)
            self.size += len(keys)

    def place(self, key: bytes) -> int:
        h = key_hash(key)
        s = shard_of(h, len(self.shards))
        seed, at, keys = self.shards[s]
        if not keys:
            return -1
        h = key_hash(key, seed) if seed else h
        slot = slot_of(h, at[h % len(at)], len(keys))
        return self.first[s] + slot if keys[slot] == key else -1  # the stored key decides

    def __missing__(self, key):
        p = self.place(key)
        if len(self) < self.LIMIT:
            self[key] = p
        return p


def perfect_hashes(keys: DataFrame, n: int):
    """A broadcast list of (seed, displacements, keys) by shard, built by one task a shard. keys: a
    string column ``term`` of n distinct values."""
    shards = max(1, -(-n // SHARD_KEYS))

    def shard(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shard_of(key_hash(t), shards) for t in text_bytes(b, "term")], pa.int64())], ["term", "shard"])

    def make(pdf):
        import pandas as pd

        seed, at, slots = build(sorted(t.encode() for t in pdf["term"]))
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "seed": [seed], "at": [at], "slots": [[k.decode() for k in slots]]})

    rows = (keys.select("term").mapInArrow(shard, "term string, shard long").repartition(shards, "shard").groupBy("shard")
            .applyInPandas(make, "shard long, seed long, at array<long>, slots array<string>").collect())  # n keys at most
    made = {r.shard: (r.seed, list(r.at), [k.encode() for k in r.slots]) for r in rows}
    return keys.sparkSession.sparkContext.broadcast([made.get(s, (0, [0], [])) for s in range(shards)])


# --- the recount --------------------------------------------------------------------

def head_cut(kept: DataFrame, slots: int) -> tuple[int, int]:
    """The document frequency (a power of two) from which all terms fit ``slots``, and how many those are."""
    short = F.octet_length("term") <= KEY_BYTES
    level = F.floor(F.log2(F.col("top").cast("double"))).cast("int")
    per = (kept.filter(short).groupBy("term").agg(F.max("df").alias("top")).groupBy(level.alias("level"))
           .agg(F.count(F.lit(1)).alias("n")).collect())  # 64 rows
    count = {r.level: r.n for r in per}
    total, least = 0, 64
    for level in sorted(count, reverse=True):
        if total + count[level] > slots:
            break
        total, least = total + count[level], level
    return least, total


def slots_of(keys: DataFrame, shards) -> DataFrame:
    """term, slot: the place of every key."""
    def run(batches):
        import pyarrow as pa

        index = Slots(shards.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([index.place(t) for t in text_bytes(b, "term")], pa.int64())], ["term", "slot"])

    return keys.select("term").mapInArrow(run, "term string, slot long")


def recount(docs: DataFrame, shards, beyond: bool) -> DataFrame:
    """lang, source, slot, term, n: occurrences of the terms in the shards, by dense slots (term is
    null). ``beyond``: of all others too, by a table of bounded size (slot is null)."""
    def run(batches):
        from collections import Counter, defaultdict

        import numpy as np
        import pyarrow as pa

        names = ["lang", "source", "slot", "term", "n"]
        index = Slots(shards.value)
        most = max(4, (16 << 20) // max(1, index.size))  # dense arrays a task holds: 128 MB at most, or four

        def rows():
            for (lang, source), slots in dense.items():
                at = np.flatnonzero(slots)
                n = len(at)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, n), pa.repeat(source, n), pa.array(at), pa.nulls(n, pa.string()), pa.array(slots[at])], names)
            for (lang, source), found in rest.items():
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, n), pa.repeat(source, n), pa.nulls(n, pa.int64()), pa.array([t.decode() for t in found], pa.string()),
                                                  pa.array(list(found.values()), pa.int64())], names)
            dense.clear()
            rest.clear()

        dense, rest, held = {}, defaultdict(Counter), 0
        for b in batches:
            for lang, source, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), text_bytes(b)):
                words = terms(text)
                if not words:
                    continue
                place = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
                group = (lang, source)
                if group not in dense:
                    if len(dense) >= most:
                        yield from rows()
                        held = 0
                    dense[group] = np.zeros(index.size, dtype=np.int64)
                known = place[place >= 0]
                np.add.at(dense[group], known, 1)
                if beyond and len(known) < len(words):
                    new = Counter(words[i] for i in np.flatnonzero(place < 0).tolist())
                    rest[group].update(new)
                    held += len(new)
                    if held >= ENTRIES:
                        yield from rows()
                        held = 0
        yield from rows()

    parts = docs.select("text", "lang", "source").mapInArrow(run, "lang string, source string, slot long, term string, n long")
    return parts.groupBy("lang", "source", "slot", "term").agg(F.sum("n").alias("n"))


def share(n: str, total: str, v: str, prior: int) -> Column:
    """p, exactly: decimals hold 10^9 times any count."""
    return F.expr(f"1 + (cast({ONE} as decimal(10,0)) * cast({n} + {prior} as decimal(20,0))) div cast({total} + {prior} * {v} as decimal(20,0))")


def pair_sums(counts: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, a, b, value for every two sources a < b of a lang: the differences of their shares
    added up over all kept terms. counts: lang, source, term, p (where n > 0); groups: lang,
    source, v, p0 (the share of count 0; null if v is 0); kept: lang, term."""
    def differences(key, pdf):
        import numpy as np
        import pandas as pd

        one, two = key[2], key[3]
        base = pdf[pdf["term"].isna()]
        source, block = base["source"].to_numpy(), base["block"].to_numpy()
        there = pdf[pdf["term"].notna()]
        column, names = pd.factorize(there["term"])
        p0, held = base["p"].fillna(0).to_numpy(dtype=np.int64), int(base["terms"].iloc[0])
        m = np.repeat(p0[:, None], len(names), axis=1)
        row = pd.Series(np.arange(len(source)), index=source)
        m[row.loc[there["source"]].to_numpy(), column] = there["p"].to_numpy(dtype=np.int64)
        out = []
        right = np.flatnonzero(block == two)
        for i in np.flatnonzero(block == one).tolist():
            js = right[source[right] > source[i]] if one == two else right
            none = (held - len(names)) * np.abs(p0[js] - p0[i])  # terms of the shard that only sources of other blocks have
            out.append(pd.DataFrame({"x": source[i], "y": source[js], "value": np.abs(m[js] - m[i]).sum(axis=1) + none}))
        return pd.concat(out).assign(lang=key[0]) if out else pd.DataFrame({"x": [], "y": [], "value": [], "lang": []})

    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.max("v").alias("v")).select(
        "lang", F.ceil(F.col("sources") / SOURCE_BLOCK).cast("long").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("v") / MATRIX_TERMS)).cast("long").alias("shards"))
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    shard = F.pmod(F.xxhash64("term"), F.col("shards"))
    per_shard = kept.join(langs, "lang").groupBy("lang", shard.alias("shard")).agg(F.count(F.lit(1)).alias("terms"))
    rows = counts.join(langs, "lang").select("lang", "source", "term", "p", "blocks", block.alias("block"), shard.alias("shard"), F.lit(0).cast("long").alias("terms")).unionByName(
        groups.join(langs, "lang").select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "blocks", block.alias("block"),
                                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
        .join(per_shard, ["lang", "shard"], "left").na.fill(0, ["terms"]))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang", "shard", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "source", "term", "p", "terms")
    parts = met.groupBy("lang", "shard", "one", "two").applyInPandas(differences, "lang string, x string, y string, value long")
    return parts.groupBy("lang", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 30, prior: int = 5, top: int = 50, slots: int = 1 << 19) -> DataFrame:
    """lang, source, part, item, value long, rank int: how far each source of a lang is from the
    others (part ``pair``), and the terms it has most above the lang's share (part ``term``)."""
    d = read(docs)
    kept = cut_lineage(document_frequency(d).filter(F.col("df") >= min_docs))
    least, n = head_cut(kept, slots)
    highest = kept.groupBy("term").agg(F.max("df").alias("top"))
    head = highest.filter((F.octet_length("term") <= KEY_BYTES) & (F.col("top") >= F.lit(2.0) ** least))
    beyond = highest.count() > n
    shards = perfect_hashes(head, n)
    found = recount(d, shards, beyond)
    slots_by_lang = kept.select("lang", "term").join(slots_of(head, shards), "term")
    counts = found.filter("slot is not null").drop("term").join(slots_by_lang, ["lang", "slot"]).select("lang", "source", "term", "n")
    if beyond:
        rest = found.filter("term is not null").drop("slot").join(kept.select("lang", "term"), ["lang", "term"])
        counts = counts.unionByName(rest.select("lang", "source", "term", "n"))
    counts = cut_lineage(counts)
    lang_v = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    group_n = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = d.select("lang", "source").distinct().join(group_n, ["lang", "source"], "left").join(lang_v, "lang", "left").na.fill(0, ["total", "v"])
    groups = cut_lineage(groups.withColumn("p0", F.when(F.col("v") > 0, share("0", "total", "greatest(v, 1)", prior))))  # a row a group
    p = counts.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "v", prior))
    lang_total = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    q = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(lang_total, "lang").select("lang", "term", share("n", "total", "v", prior).alias("q"))
    over = p.join(q, ["lang", "term"]).filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ab = pair_sums(p.select("lang", "source", "term", "p"), groups, kept.select("lang", "term"))
    both = ab.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        ab.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order)
    return (both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
            .unionByName(over.withColumn("rank", rank).filter(F.col("rank") <= top)))
