"""Keyword join (F2) against contains."""
import random

from pyspark.sql import functions as F

from pressforge.operators import keywords as K


def test_equals_contains(spark):
    rng = random.Random(1)
    letters = "abcäß中 "
    texts = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(120)] + [(200, None), (201, ""), (202, "AbC" * 2000)]
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(150)} | {"a", "中", "ABCABC", "zzz", "abz"}
    table = [(w, f"t{i % 3}") for i, w in enumerate(sorted(words))] + [("a", "again"), ("", "none"), (None, "none")]
    got = K.keyword_join(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(table, "keyword string, tag string"))
    want = sorted((i, w, t) for i, x in texts for w, t in table if x is not None and w and w.lower() in x.lower())
    assert sorted((r.id, r.keyword, r.tag) for r in got.collect()) == want and len(want) > 1000


def test_no_keywords_and_no_texts(spark):
    t = spark.createDataFrame([(1, "abc")], "id long, text string")
    k = spark.createDataFrame([("abc",)], "keyword string")
    assert K.keyword_join(t, k.limit(0)).collect() == [] and K.keyword_join(t.limit(0), k).collect() == []
    assert [tuple(r) for r in K.keyword_join(t, k).collect()] == [(1, "abc")]


def test_no_nested_loop(spark):
    t = spark.createDataFrame([(1, "abc")], "id long, text string").withColumn("text", F.concat("text", "text"))
    plan = K.keyword_join(t, spark.createDataFrame([("abc",)], "keyword string"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_grams_of_a_text(spark):
    """The grams of a text come as numbers from Arrow batches, each once; a short text has its own."""
    df = spark.createDataFrame([(1, "abab"), (2, "\U0001F600b"), (3, ""), (4, None)], "id long, text string")
    n = lambda s: sum(ord(c) << 21 * (len(s) - 1 - i) for i, c in enumerate(s))
    got = sorted((r.id, r.g) for r in K.explode_grams(df, "id", "text", [2, 3]).collect())
    assert got == sorted([(1, n("ab")), (1, n("ba")), (1, n("aba")), (1, n("bab")), (2, n("\U0001F600b"))])
    own = sorted((r.id, r.g) for r in K.explode_grams(df, "id", "text", [1, 2, 3], own=True).collect())
    assert own == sorted([(1, n("aba")), (1, n("bab")), (2, n("\U0001F600b"))])
