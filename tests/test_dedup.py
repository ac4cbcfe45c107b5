"""Banded near-dup join = brute force; greedy rounds = sequential loop."""
import random

from pyspark.sql import functions as F

from pressforge.operators import dedup as D
from pressforge.operators import neardup as N


def _signed(x):
    return x - (1 << 64) if x >= (1 << 63) else x


def _hashes(n=300, seed=3):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(n)]
    out = []
    for i, h in enumerate(base):
        out.append(h)
        if i % 3 == 0:  # planted neighbours at distance 1..4
            flips = rnd.sample(range(64), rnd.randint(1, 4))
            g = h
            for b in flips:
                g ^= 1 << b
            out.append(g)
        if i % 10 == 0:  # exact copies
            out.append(h)
    return [_signed(x) for x in out]


def _brute_pairs(hs, k=3):
    vals = sorted(set(hs))
    return {(a, b) for i, a in enumerate(vals) for b in vals[i + 1:] if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= k}


def test_banded_equals_brute(spark):
    hs = _hashes()
    df = spark.createDataFrame([(h,) for h in hs], "h long")
    want = _brute_pairs(hs)
    for bands in (4, 6):
        got = {(r.ha, r.hb) for r in N.near_pairs(df, bands=bands).collect()}
        assert got == want and len(want) > 50


def _greedy(rows, k=3):
    kept_h, kept_t, out = [], set(), []
    for i, h, t in rows:
        near = any(bin((h ^ g) & ((1 << 64) - 1)).count("1") <= k for g in kept_h)
        if near or (t is not None and t in kept_t):
            continue
        kept_h.append(h)
        if t is not None:
            kept_t.add(t)
        out.append(i)
    return set(out)


def test_greedy_equals_sequential(spark):
    hs = _hashes(150)
    rows = [(i, h, f"cap{i % 17}") for i, h in enumerate(hs)]
    df = spark.createDataFrame(rows, "id long, h long, text string").withColumn("accept_order", F.col("id"))
    edges = N.neighbour_edges(N.near_pairs(df))
    got = {r.id for r in D.greedy_keep(df, "accept_order", [("h", edges)]).filter("kept").collect()}
    assert got == _greedy([(i, h, None) for i, h, _ in rows])
    got2 = {r.id for r in D.greedy_keep(df, "accept_order", [("h", edges), ("text", None)]).filter("kept").collect()}
    assert got2 == _greedy(rows)


def test_first_wins(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, "b"), (4, "c")], "accept_order long, text string")
    got = sorted((r.text, r.accept_order) for r in D.first_wins(df, ["text"]).collect())
    assert got == [("a", 1), ("b", 2), ("c", 4)]


def test_any_band_count_is_exact(spark):
    hs = _hashes(120)
    df = spark.createDataFrame([(h,) for h in hs], "h long")
    for m in (4, 6, 7):
        masks = N.band_masks(m)
        assert sum(bin(x).count("1") for x in masks) == 64
        got = {(r.ha, r.hb) for r in N.near_pairs(df, bands=m).collect()}
        v = sorted(set(hs))
        assert got == {(x, y) for i, x in enumerate(v) for y in v[i + 1:] if bin((x ^ y) & (2 ** 64 - 1)).count("1") <= 3}


def test_greedy_rounds_do_not_read_the_source_again(spark, tmp_path):
    """Chains of conflicts need several rounds; each works on cut tables only."""
    df = spark.createDataFrame([(i, (1 << min(63, i)) - 1) for i in range(40)], "id long, h long").withColumn("accept_order", F.col("id"))
    df.write.parquet(str(tmp_path / "src"))
    src = spark.read.parquet(str(tmp_path / "src"))
    out = D.greedy_keep(src, "accept_order", [("h", N.neighbour_edges(N.near_pairs(src)))])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert {r.id for r in out.filter("kept").collect()} == _greedy([(i, (1 << min(63, i)) - 1, None) for i in range(40)])


def test_null_hash_conflicts_with_nothing(spark):
    rows = [(1, 1, None, "a"), (2, 2, None, "b"), (3, 3, 5, "c"), (4, 4, 5, "d"), (5, 5, None, "a")]
    df = spark.createDataFrame(rows, "id long, accept_order long, h long, text string")
    edges = N.neighbour_edges(N.near_pairs(df))
    kept = {r.id for r in D.greedy_keep(df, "accept_order", [("h", edges), ("text", None)]).filter("kept").collect()}
    # 1, 2 unreadable but distinct captions: kept; 4 repeats hash 5 of kept 3; 5 repeats caption "a" of kept 1
    assert kept == {1, 2, 3}


def test_near_pairs_is_not_broadcast(spark):
    """The band keys are many rows a hash; broadcasting them for the hashes' size took the driver's memory."""
    from pressforge.operators import neardup as N

    d = spark.range(2000).selectExpr("xxhash64(id) AS h")
    for bands in (6, 7):
        q = N.near_pairs(d.union(d.selectExpr("h ^ 5")), bands=bands)
        q.collect()
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("Initial Plan")[0]
