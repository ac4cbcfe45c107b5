"""The training-data operators against brute force, and on awkward tables."""

import math
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pressforge.llm import components, decontam, langid, lm, ngram_join, packing, pii, quality, queries, substring, suffix, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def awkward(spark):
    """Null and empty texts, a null id, a repeated row, ties, a long text; names that the operators use themselves."""
    rng = random.Random(5)
    long = " ".join(rng.choice("the of and ein une para token") + str(rng.randint(0, 9)) for _ in range(60_000))
    same = "One two three four five six seven eight nine ten eleven twelve. " * 5
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, same), (5, same), (6, same + "x"), (6, same + "x"), (None, same), (None, None), (7, long), (8, "!!! ..."),
             (9, "Ünïcødé 中文 слова mail a@b.co and 10.0.0.1 or +1 555 0100 2000"), (10, "a" * 5000), (11, "ab" * 3000)]
    df = spark.createDataFrame([(i, t, "en" if i != 9 else None, "s", 0 if t is None else len(t)) for i, t in texts], SCHEMA)
    clash = {c: F.lit(c) for c in ("k1", "k2", "row", "node", "score", "h", "pos", "rank", "length", "text__scored", "lang_pred", "new", "all", "word.count")}
    return df.withColumns({c: v for c, v in clash.items() if "." not in c}), texts


def tables(spark, df):
    items = spark.createDataFrame([(1, "three four five six seven eight nine ten eleven twelve one two"), (2, None), (3, ""), (4, "Ünïcødé 中文")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 0, 1), (7, 1, 0), (5, 1, 0), (7, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return {
        "op1": lambda: substring.dedup(df), "op2": lambda: quality.clean(df), "op3": lambda: packing.pack(df), "op4": lambda: pii.report(df),
        "op5": lambda: toxicity.classify(df, labels), "op6": lambda: lm.evaluate(df), "op7": lambda: langid.identify(df), "op8": lambda: suffix.dedup(df),
        "op9": lambda: decontam.report(df, items), "op10": lambda: ngram_join.join(df)}


def test_awkward_rows(spark):
    df, texts = awkward(spark)
    for name, make in tables(spark, df).items():
        got = make().collect()
        assert len({r.doc_id for r in got}) == 12 and (len(got) == len(texts) or name == "op3"), name
        if name == "op2":
            want = sorted(brute.quality(t) for _, t in texts)
            assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
        if name == "op4":
            want = [",".join(f"{k}:{a}:{b}" for k, a, b in brute.pii(t)) for _, t in texts]
            assert sorted(r.base_sha256 for r in got) == sorted(map(brute.sha, want))
        if name == "op6":
            want = brute.unigrams(texts)
            assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == sorted(w[:3] for w in want)
            assert np.allclose(sorted(r.base_score for r in got), sorted(w[3] for w in want))
        if name == "op8":
            assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(brute.suffix([t for _, t in texts]))
        if name == "op9":
            items = [(1, "three four five six seven eight nine ten eleven twelve one two"), (2, None), (3, ""), (4, "Ünïcødé 中文")]
            assert sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(brute.leaks([t for _, t in texts], items))
        if name == "op10":
            want = brute.jaccard([x for x in dict(x for x in texts if x[0] is not None).items()])
            assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)
            assert all(r.component_id is None for r in got if r.doc_id is None)
        if name == "op7":
            assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 8)} == {"und"}


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    for name, make in tables(spark, df).items():
        assert make().collect() == [], name
    none = spark.createDataFrame([], "item_id long, text string")
    some, _ = awkward(spark)
    assert not any(r.contaminated for r in decontam.report(some, none).collect())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.predicted == 0 for r in toxicity.classify(some, none).collect())


def test_stages_keep_columns(spark, tmp_path):
    df, _ = awkward(spark)
    spark.createDataFrame([(1, "three four five six seven eight nine ten eleven twelve")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns
        df = out.cache()
    ids = [r.doc_id for r in df.collect()]
    assert 1 not in ids and 4 not in ids and 7 in ids
    nine = [r for r in df.collect() if r.doc_id == 9][0]
    assert nine.text == "Ünïcødé 中文 слова mail [email] and [ip] or [phone]" and nine.n_chars == len(nine.text)


def test_pipeline_whole(spark, rows, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).cache()
    want = {i for i, (_, c) in brute.jaccard(rows).items() if i == c}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want
    clean = corpus_pipeline.decontamination(spark, kept, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {i for (i, t), x in zip(rows, brute.leaks([t for _, t in rows], items)) if x[4]}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == want - hit
    out = queries.QUERIES["pipeline"](spark, SF).collect()
    assert {r.doc_id for r in out} == want - hit
    assert max(r.offset + r.length for r in out) <= packing.CAPACITY


def test_quality_counts(docs, rows):
    got = by_id(quality.clean(docs))
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(t)


def test_quality_lines(spark):
    words = [f"{a}{b}" for a in ("stone", "river", "cloud", "garden", "winter", "letter", "market", "signal") for b in ("light", "path", "house", "song", "field", "bridge", "water", "fire")]
    good = "\n".join(" ".join(words[8 * i:8 * i + 8]).capitalize() + "." for i in range(8))
    bad = "\n".join(["Home | News | About | Contact | Help | Login"] * 3 + ["All rights reserved."] + ["### *** $$$ %%% &&&"] * 2)
    df = spark.createDataFrame([(1, good), (2, good + "\n" + bad), (3, bad + "\n" + "\n".join(f"{k} Menu {k} | Item {k} | More {k} | Go {k}" for k in range(30)))], "doc_id long, text string")
    got = by_id(quality.clean(df))
    assert got[1].kept and got[1].clean_text == good and got[1].n_lines_removed == 0
    assert got[2].kept and got[2].clean_text == good and got[2].n_lines_removed == 6
    assert not got[3].kept and got[3].clean_text == ""


def test_quality_notices_are_whole_words(spark):
    keep = ["The catalog in the reading room lists nine thousand titles.", "She baked a chocolate cookie for the long way home.", "They subscribe to it, and threads more than once."]
    drop = ["Todos los derechos reservados.", "© 2020 Alle Rechte vorbehalten.", "This site uses cookies.", "Please log in.", "READ MORE.", "Tous droits réservés !"]
    got = quality.clean(spark.createDataFrame([(0, "\n".join([*keep, *drop]))], "doc_id long, text string")).first()
    assert got.clean_text == "\n".join(keep) and got.n_lines_removed == len(drop)


def test_pii_base(docs, rows):
    got = by_id(pii.report(docs))
    for i, t in rows:
        assert got[i].base_sha256 == brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in brute.pii(t)))


def test_pii_edges(spark):
    texts = ["x@y.com_z@w.org", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 01.02.003.0004", "4111 1111-1111 1111", "4111 1111 1111 1112", "+1 (555) 010-2000x", "+1", "++49 30 1234567890123",
             "é@é a@é.b b@c.d.", "." * 3000 + "@a.b", "1." * 3000 + "1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(pii.report(df))
    for i, t in enumerate(texts):
        assert got[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in brute.pii(t)), t


def test_pii_bootstrap_finds_new_formats(spark):
    """A context that holds addresses only tells of a number that is none; clean numbers stay."""
    hidden, clean = "write to reach me via 999.888.777.66 today ok", "the year 1999 was not 20000 long"
    same = [f"write to reach me via {i + 1}.{i}.1.{i + 100} today ok" for i in range(40)]
    got = by_id(pii.report(spark.createDataFrame(list(enumerate([*same, hidden, clean])), "doc_id long, text string")))
    assert all(got[i].n_ip == 1 and got[i].spans == f"ip:22:{len(t) - 9}" for i, t in enumerate(same))
    assert got[40].n_ip == 0 and got[40].spans == "id:22:36" and got[41].spans == ""
    few = [*same[:3], hidden, clean]  # too few seeds to make a pattern
    got = by_id(pii.report(spark.createDataFrame(list(enumerate(few)), "doc_id long, text string")))
    assert got[3].spans == "" and got[4].spans == ""


def test_pii_every_token_is_an_instance(spark):
    """Addresses without four digits are seeds and are found; so are numbers written in groups, as a whole."""
    name = [a + b for a in "abcdefgh" for b in "klmnopq"]
    texts = [f"please send mail to {n}@{n}.org before noon" for n in name[:40]] + ["please send mail to someone@localhost before noon"]
    texts += [f"you can reach me under +1 555 010 {1000 + i} all day" for i in range(40)] + ["you can reach me under +1 (171) 55, all day"]
    texts += [f"my line is +1 5{i} 010 {1000 + i} or so" for i in range(10, 50)] + ["my line is +1 23 456 78 or so", "in 1999 there were 3 of 12 500 left"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, n = by_id(pii.report(df)), len(texts)
    assert got[40].spans == "id:20:37" and got[n - 1].spans == ""
    assert got[n - 2].spans == "id:11:23"
    clean = {r.doc_id: r.text for r in pii.redact(df.withColumn("n_chars", F.length("text"))).collect()}
    assert clean[n - 2] == "my line is [id] or so" and clean[40] == "please send mail to [id] before noon"


def test_pii_discovered_instances_support(spark):
    """Tokens found in one pattern carry a pattern of their own."""
    edges = [(f"s{i}", True, ["a"]) for i in range(60)] + [(f"d{i}", False, ["a", "b"]) for i in range(6)] + [(f"x{i}", False, ["c"]) for i in range(6)]
    good = pii.good_patterns(spark.createDataFrame(edges, "token string, seed boolean, patterns array<string>"), threshold=0.7)
    assert {r.p for r in good.collect()} == {"a", "b"}


def test_leaks(spark, docs, rows):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    listed = [(r.item_id, r.text) for r in items.collect()]
    cut = [(1000 + n, " ".join(brute.ALNUM.findall(rows[3][1])[5:5 + n])) for n in range(1, 12)]  # items of one to eleven words
    more = items.unionByName(spark.createDataFrame(cut, items.schema))
    got = by_id(decontam.report(docs, more))
    for (i, _), want in zip(rows, brute.leaks([t for _, t in rows], listed + cut)):
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want


def test_jaccard(docs, rows):
    want = brute.jaccard(rows)
    for r in ngram_join.join(docs).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id]


def test_jaccard_group_of_near_copies(spark):
    """A chain and a large group, with cells small enough to split blocks."""
    rng = random.Random(1)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(120)]
    texts = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 99)}"
        texts.append((i, " ".join(w)))
    w = [f"c{rng.randint(0, 9999)}" for _ in range(120)]
    for i in range(60, 90):  # each a step further from the first
        w[(i * 2) % 120] = f"y{i}"
        texts.append((i, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute.jaccard(texts)
    for cell in (3, 2048):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df, cell=cell).collect()} == want


def test_rtree_loses_nothing():
    rng = np.random.default_rng(0)
    centre = rng.integers(0, 12, size=(40, 64))
    points = np.maximum(0, centre[rng.integers(0, 40, 1500)] + rng.integers(-1, 2, size=(1500, 64)))
    n = points.sum(axis=1)
    every = np.arange(1500)
    got = set(zip(*(x.tolist() for x in ngram_join.cell_pairs(points, n, every[::50], every, 85))))
    want = set()
    for k, q in enumerate(range(0, 1500, 50)):
        o = np.minimum(points, points[q]).sum(axis=1)
        want |= {(i, k) for i in np.flatnonzero((o >= ngram_join.needed(n, n[q], 85)) & (np.minimum(n, n[q]) * 100 >= np.maximum(n, n[q]) * 85)).tolist()}
    assert got == want


def test_bound_is_never_too_low():
    rng = np.random.default_rng(6)
    for size in (3, 40, 700, 9000):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(size * 0.93)], rng.integers(0, 2**63, max(1, size // 30), dtype=np.uint64)]))
        if 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
            x, y = (ngram_join.unpacked(ngram_join.packed(ngram_join.point(s)), len(s)) for s in (a, b))
            assert ngram_join.may_link(x, len(a), y, len(b), 85)
            x, y = (ngram_join.unpacked(ngram_join.packed(ngram_join.folded(ngram_join.point(s))), len(s)) for s in (a, b))
            assert ngram_join.may_link(x, len(a), y, len(b), 85)
    many = np.arange(1, 400_000, dtype=np.uint64) << np.uint64(20)  # all in one group
    x = ngram_join.unpacked(ngram_join.packed(ngram_join.point(many)), len(many))
    assert ngram_join.may_link(x, len(many), x, len(many), 85)


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == top(x) for x in list(parent))


def test_suffix(docs, rows):
    got = by_id(suffix.dedup(docs))
    for (i, _), want in zip(rows, brute.suffix([t for _, t in rows])):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want and brute.sha(bytes(r.kept)) == r.kept_sha256


def test_suffix_counted_windows(docs, rows):
    """The way for anchors of very many runs gives the same result."""
    got = by_id(suffix.dedup(docs.filter("doc_id < 120"), wide=1))
    few = [(i, t) for i, t in rows if i < 120]
    for (i, _), want in zip(few, brute.suffix([t for _, t in few])):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want


def test_suffix_sort_order():
    rng = np.random.default_rng(3)
    buf = rng.integers(97, 99, size=6000).astype(np.uint8)
    buf[3000:3600] = buf[100:700]
    sorter = suffix.SuffixSorter(buf, suffix.Powers())
    s = rng.permutation(5000)[:1500].astype(np.int64)
    classes = np.sort(rng.integers(0, 3, size=1500))
    out = sorter.sort(s, classes)
    for c in range(3):
        part = [bytes(buf[i:i + suffix.LENGTH]) for i in out[classes == c]]
        assert part == sorted(bytes(buf[i:i + suffix.LENGTH]) for i in s[classes == c])


def test_substring(docs, rows):
    got, seen = by_id(substring.dedup(docs)), set()
    for i, t in rows:
        found = substring.sentences((t or "").encode())
        gone, k = set(), min(2, len(found))
        for q in range(len(found) - k + 1 if found else 0):
            key = tuple(s[2] for s in found[q:q + k])
            if sum(s[3] for s in found[q:q + k]) >= 15:
                gone |= set(range(q, q + k)) if key in seen else set()
                seen.add(key)
        assert (got[i].n_sentences, got[i].n_removed) == (len(found), len(gone))
        assert got[i].clean_text.encode() == cut_out(t, found, gone)


def cut_out(text, found, gone):
    """The text without the sentences ``gone``."""
    out, at = [], 0
    for j in sorted(gone):
        out.append((text or "").encode()[at:found[j][0]])
        at = found[j][1]
    return b"".join(out) + (text or "").encode()[at:]


def brute_stretches(texts, least=15):
    """The query's way, in plain Python: sentences to remove of every text, in order."""
    all_found = [substring.sentences((t or "").encode()) for t in texts]
    forms = [[s[2] for s in found] for found in all_found]
    runs, singles, wholes, out = set(), set(), set(), []
    for found, f in zip(all_found, forms):
        covered, gone = set(), set()
        for q in range(len(f) - 1):
            if (f[q], f[q + 1]) in runs:
                covered |= {q, q + 1}
            runs.add((f[q], f[q + 1]))
        starts = sorted(q for q in covered if q - 1 not in covered)
        for q in starts:
            e = q
            while e + 1 in covered:
                e += 1
            if sum(found[x][3] for x in range(q, e + 1)) >= least:
                gone |= set(range(q, e + 1))
        for q, s in enumerate(found):
            if s[3] >= least:
                gone |= {q} if f[q] in singles else set()
                singles.add(f[q])
        if tuple(f) in wholes:
            gone = set(range(len(f)))
        if f:
            wholes.add(tuple(f))
        out.append((found, gone))
    return out


def test_substring_query_path(docs, rows):
    """op1 as the query calls it, on the given table."""
    got = by_id(substring.dedup(docs, stretch_words=15))
    removed = 0
    for (i, t), (found, gone) in zip(rows, brute_stretches([t for _, t in rows])):
        assert (got[i].n_sentences, got[i].n_removed) == (len(found), len(gone)), i
        assert got[i].clean_text.encode() == cut_out(t, found, gone)
        removed += len(gone)
    assert removed > 50


def test_substring_stretch_over_several_documents(spark):
    """A stretch counts whole, also where its runs were first in different documents; the awkward
    rows and the empty table on the query's path."""
    s = [f"{w} one two three four." for w in ("Alpha", "Beta", "Gamma", "Delta")]
    texts = [" ".join(s[:3]), " ".join(s[2:]), " ".join(s[1:]), "Beta one two three four. Gamma one two three four."]
    got = by_id(substring.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), stretch_words=15))
    assert [got[i].n_removed for i in range(4)] == [0, 0, 3, 0] and got[2].clean_text == ""
    df, odd = awkward(spark)
    found = substring.dedup(df, stretch_words=15).collect()
    assert len(found) == len(odd) and {r.clean_text for r in found if r.doc_id == 1} == {""}
    assert substring.dedup(df.limit(0), stretch_words=15).collect() == []


def test_substring_stretches(spark):
    """The query's way: short sentences repeat as a stretch, a copy loses all, chance pairs stay."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]

    def short(n):
        return [" ".join(rng.choice(words) for _ in range(5)) + "." for _ in range(n)]

    a, b, lone, item = short(8), short(3), " ".join(words[:20]) + ".", ["Buy now.", "Call us.", "Read on."]
    chance = ["Yes.", "No."]
    texts = [(1, " ".join([*short(2), *a, *short(2)])), (2, " ".join([*a[2:4], *short(3)])), (3, " ".join([*short(1), *a, *chance, *short(1)])),
             (4, " ".join([*short(2), lone, *short(2)])), (5, " ".join([*short(1), lone, *short(1)])), (6, " ".join([*short(1), *chance, *short(1)])),
             (7, "Hi. Ho."), (8, "hi. ho."), (9, " ".join(item * 6)), (10, " ".join([*short(1), *b, *short(1)])),
             (11, "これは長い文です。もう一つの文です。" + " ".join(words[30:50])), (12, "別の始まり。これは長い文です。もう一つの文です。" + " ".join(words[30:50]))]
    texts += [(20 + i, " ".join(a[i:i + 2])) for i in range(0, 8, 4)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = by_id(substring.dedup(df, stretch_words=15))
    assert got[1].n_removed == 0 and got[2].n_removed == 0 and got[10].n_removed == 0
    assert (got[3].n_sentences, got[3].n_removed) == (12, 8) and "Yes. No." in got[3].clean_text
    assert (got[5].n_removed, got[6].n_removed, got[7].n_removed, got[8].n_removed, got[8].clean_text) == (1, 0, 0, 2, "")
    assert got[9].n_removed == 15 and got[9].clean_text.split() == " ".join(item).split()
    assert (got[12].n_sentences, got[12].clean_text) == (4, "別の始まり。")
    assert substring.dedup(df).filter("doc_id = 3 and n_removed = 0").count() == 1  # runs of ten words, under the minimum of the default
    assert queries.QUERIES["op1_substring_dedup"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_packing(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    got = packing.pack(docs).collect()
    want = set()
    for (i, _), e in zip(rows, tok.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 0], dtype="<u4")
        want |= {(i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
    assert len(filled) == brute.bfd([r.length for r in got], 2048)


def test_packing_with_another_tokeniser(docs, rows):
    """A tokeniser that keeps case and white space reads whole texts."""
    import public_tokenizers
    from tokenizers import Tokenizer

    name = "byte_bpe_50k.json"
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    got = {(r.doc_id, r.piece): (r.length, r.ids_crc32) for r in packing.pieces(docs, tokenizer=name).collect()}
    for (i, t), e in zip(rows, tok.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 0], dtype="<u4")[:2048]
        assert got[i, 0] == (len(ids), zlib.crc32(ids.tobytes()))


def test_packing_equals_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([7, 16, 40])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 120))]
        counts = {s: lengths.count(s) for s in set(lengths)}
        filled, placed = {}, {}
        for s, first, n, per, b, base in packing.best_fit_decreasing(counts, capacity):
            for i in range(n):
                assert first + i == placed.get(s, 0)
                placed[s] = first + i + 1
                assert filled.get(b + i // per, 0) == base + i % per * s
                filled[b + i // per] = base + i % per * s + s
        assert placed == counts and max(filled.values()) <= capacity and len(filled) == brute.bfd(lengths, capacity)


def test_encoder_equals_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    tok, enc, rng = Tokenizer.from_file(path), packing.Encoder(path), random.Random(3)
    letters = list("abcXYZéÉßẞÅKİσΣς'’`.,!?-_#<|>/\\[]{}~09½µªº ÷ ́̈\x0b\x1c\x85\t\n  ñÑüœŒđ中日한اب😀‍") + ["<|endoftext|>", "<|StartOfText|>", "'s", "'LL", "don't", "..."]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert enc.ids([t.encode() for t in texts]) == want


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.rejected for r in got]) < 0.01


def test_language_of_many_copies(spark):
    """The sample is drawn from the distinct texts, so copies don't thin it out."""
    one = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("the quick brown fox and the lazy dog").alias("text"), F.lit("en").alias("lang"))
    assert {(r.lang_pred, r.rejected) for r in langid.identify(one).select("lang_pred", "rejected").distinct().collect()} == {("en", False)}
    few = spark.createDataFrame([(50_000 + i, f"der schnelle braune Fuchs und ein fauler Hund Nummer {chr(97 + i)}", "de") for i in range(20)], "doc_id long, text string, lang string")
    got = langid.identify(one.union(few)).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in got} == {"en": 40_000, "de": 20}


def test_language_rejection_at_any_length(spark):
    """Lengths that few training texts have get a threshold from their neighbours."""
    bands, cos = np.array([6] * 30 + [9] * 40 + [12] * 3), np.array([0.4] * 30 + [0.6] * 40 + [0.7] * 3)
    low = langid.thresholds(cos, bands)
    assert math.isclose(low[6], 0.24) and math.isclose(low[9], 0.36) and all(x >= 0.36 for x in low[12:])
    assert 0 < low[2] < low[4] < low[6] and langid.thresholds(cos[:19], bands[:19]) == [0.0] * 64
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(11)
    foreign = [(10**9 + i, " ".join("".join(rng.choice("абвгдежзийклмнопрстуфхцчшщыьэюя") for _ in range(rng.randint(2, 9))) for _ in range(n)), None)
               for i, n in enumerate((60, 600, 3000, 12000))]
    got = langid.keep_known(docs.unionByName(spark.createDataFrame(foreign, docs.schema)))
    n = docs.filter("text rlike '[a-zA-Z]'").count()
    assert got.filter("doc_id >= 1000000000").count() == 0 and got.count() > 0.99 * n


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.classify(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    s, y = np.array([r.score for r in got]), np.array([r.toxic for r in got])
    rank = np.empty(len(s))
    rank[np.argsort(s, kind="stable")] = np.arange(len(s))
    n = y.sum()
    assert (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n)) > 0.95
    assert (s[y == 1] >= 0.5).mean() > 0.7 and (s[y == 0] >= 0.5).mean() < 0.01


def test_language_model(docs, rows):
    got = by_id(lm.evaluate(docs))
    for (i, _), want in zip(rows, brute.unigrams(rows)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and math.isclose(r.base_score, want[3], rel_tol=1e-9)
        assert r.score <= 0 and r.held_out == (brute.crc(i) % 5 == 1)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_small_table(docs, rows):
    """Counts that aren't in the broadcast table are joined: the base score stays exact."""
    got = by_id(lm.evaluate(docs, table_words=50, lm_words=10, max_bits=16))
    for (i, _), want in zip(rows, brute.unigrams(rows)):
        assert got[i].n_known == want[1] and math.isclose(got[i].base_score, want[3], rel_tol=1e-9)


def test_language_model_beyond_the_filter(docs, rows):
    """N-grams that the filter has no room for are joined: the score is that of a filter with room for all."""
    whole, few = (by_id(lm.evaluate(docs, max_bits=b)) for b in (30, 16))
    off = np.array([(few[i].score - whole[i].score) / whole[i].n_tokens for i, _ in rows])
    assert np.abs(off).max() < 0.3 and np.abs(off).mean() < 0.03  # not 0, as a filter reads some counts too high


def test_bloom_counts(spark):
    counts = {int(h): int(c) for h, c in zip(np.random.default_rng(1).integers(-2**62, 2**62, 3000), np.random.default_rng(2).zipf(1.5, 3000).clip(max=10**6))}
    df = spark.createDataFrame(list(counts.items()), "h long, c long").repartition(3, lm.block_of(F.col("h")))
    bloom = lm.BloomCounts(*lm.build_filter(df, 20))
    h, c = np.array(list(counts), dtype=np.int64).view(np.uint64), np.array(list(counts.values()))
    level = np.searchsorted(lm.STEPS, c, side="right")
    found = bloom.levels(h)
    assert (found >= level).all() and (found == level).mean() > 0.95  # a filter never reads too low


def test_queries_registered():
    names = set(queries.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
