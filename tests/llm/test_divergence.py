"""Source divergence audit against plain Python, perfect hashes, and awkward tables."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pressforge.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=30, prior=5, top=50):
    docs = [(lang or "", source or "", [t.translate(LOWER) for t in TERM.findall(text or "")]) for text, lang, source in rows]
    df, groups = Counter(), defaultdict(Counter)
    for lang, _, ts in docs:
        df.update((lang, t) for t in set(ts))
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= min_docs:
            kept[lang].append(t)
    for lang, source, ts in docs:
        groups[lang, source].update(t for t in ts if df[lang, t] >= min_docs)
    whole = defaultdict(Counter)
    for (lang, _), c in groups.items():
        whole[lang].update(c)

    def p(c, lang, t):
        return 1 + 10**9 * (c[t] + prior) // (sum(c.values()) + prior * len(kept[lang]))

    out = []
    shares = {g: {t: p(c, g[0], t) for t in kept[g[0]]} for g, c in groups.items()}
    lang_shares = {lang: {t: p(c, lang, t) for t in kept[lang]} for lang, c in whole.items()}
    for (lang, source), c in groups.items():
        mine = shares[lang, source]
        pair = [(sum(abs(mine[t] - shares[lang, o][t]) for t in kept[lang]), o) for x, o in groups if x == lang and o != source]
        term = [(mine[t] - lang_shares[lang][t], t) for t in kept[lang] if c[t] and mine[t] > lang_shares[lang][t]]
        for part, items, most in (("pair", pair, None), ("term", term, top)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("Ant", "bee", "Çat", "dog", "eel", "fox", "中", "gnu") for b in ("a", "Be", "ü", "do", "eé", "f", "ü中", "zZ")] + ["x" * 80, "É" * 40]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 else f"s{i % 11}"
        text = None if i % 37 == 0 else " 1,2-".join(rng.choice(words[:10 + i % 56]) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["de", "en", None, ""]), None if i % 29 == 0 else source))
    rows += [("no term kept here", "xx", s) for s in ("a", "b", "c")] + [("123", "yy", "alone")] + [("Ant bee", "en", "")] * 5
    return rows, spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], SCHEMA).repartition(5)


def test_made_table(made):
    rows, df = made
    assert result(divergence.audit(df)) == brute(rows)
    assert result(divergence.audit(df, min_docs=3, prior=1, top=7)) == brute(rows, 3, 1, 7)


def test_terms_beyond_the_broadcast(made):
    """With room for few or no keys the rest are counted by the join: the same result."""
    rows, df = made
    want = brute(rows, 3)
    for slots in (20, 0):
        assert result(divergence.audit(df, min_docs=3, slots=slots)) == want


def test_small_memory(made, monkeypatch):
    """Tables that are emptied again and again, matrices of a few terms, blocks of a few sources."""
    rows, df = made
    for name, value in (("ENTRIES", 50), ("MATRIX_TERMS", 3), ("SOURCE_BLOCK", 2), ("SHARD_KEYS", 5)):
        monkeypatch.setattr(divergence, name, value)
    assert result(divergence.audit(df, min_docs=3, slots=30)) == brute(rows, 3)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert result(divergence.audit(df)) == brute(rows)


def test_perfect_hash():
    for n in (1, 2, 3, 7, 500, 4096):
        keys = [f"k{i * 7919}é".encode() for i in range(n)]
        seed, at, slots = divergence.build(keys)
        assert sorted(slots) == sorted(keys)  # minimal and without collision
        index = divergence.Slots([(0, [0], []), (seed, at, slots)] if n == 1 else [(seed, at, slots)])
        places = {index[k] for k in keys} if n > 1 else {0}
        assert places == set(range(n))
        if n > 1:
            assert all(slots[index[k]] == k for k in keys)
            assert {index[f"other{i}".encode()] for i in range(5000)} == {-1}  # the stored key decides


def test_equal_hashes_get_another_seed(monkeypatch):
    real = divergence.key_hash
    monkeypatch.setattr(divergence, "key_hash", lambda k, seed=0: 7 if seed == 0 and k in (b"a", b"b") else real(k, seed))
    seed, at, slots = divergence.build([b"a", b"b", b"c"])
    assert seed > 0 and sorted(slots) == [b"a", b"b", b"c"]


def test_awkward_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(empty).collect() == []
    rows = [(None, None, None), ("", "", ""), ("a", None, "b"), ("word " * 200_000, "en", "s")] + [("same text", "en", "t")] * 40
    df = spark.createDataFrame([(1, *r, 0) for r in rows], SCHEMA).withColumns({c: F.lit(c) for c in ("term", "df", "n", "p", "q", "v", "total", "block", "shard", "value", "rank", "item", "part")})
    assert result(divergence.audit(df)) == brute(rows)
