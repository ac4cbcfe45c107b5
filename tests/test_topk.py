"""Exact top-k (I3): against all pairs, on clustered, copied and odd vectors."""
import numpy as np
import pytest

from pressforge.operators import topk as K

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k, dims):
    ok = [(i, np.asarray(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and len(v) == dims
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q in queries:
        for i, v in ok:
            if i == q:
                s = [(-round(float(v @ w / np.sqrt((v @ v) * (w @ w))), 9), j) for j, w in ok if j != i]
                out += [(q, r, j, -d) for r, (d, j) in enumerate(sorted(s)[:k], 1)]
    return sorted(out)


def found(spark, rows, queries, k, **conf):
    df = spark.createDataFrame([(i, v) for i, v in rows], SCHEMA).repartition(3)
    q = df.filter(df.vec_id.isin(*queries))
    return sorted((r.query, r["rank"], r.neighbour, r.score) for r in K.background_topk(df, q, k, **conf).collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-9)


def clustered(n, dims, groups, spread, seed):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(groups, dims))
    return [(i, (c[i % groups] + spread * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_equals_all_pairs(spark, spread):
    rows = clustered(600, 8, 12, spread, 1)
    same(found(spark, rows, range(0, 600, 20), 7, dims=8, pivots=16, rings=4), brute(rows, range(0, 600, 20), 7, 8))


def test_a_third_are_copies(spark, monkeypatch):
    """One vector holds a third of the rows: its ring is dealt out in many blocks, ties go by id."""
    monkeypatch.setattr(K, "BLOCK", 20)
    rows = clustered(200, 6, 5, 0.4, 2) + [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(100)]
    queries = [0, 7, 1000, 1050]
    same(found(spark, rows, queries, 5, dims=6, pivots=8, rings=3), brute(rows, queries, 5, 6))


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1e-30, 1e-30]), (3, [1e30, 1e30]), (4, [0.0, 0.0]), (5, None), (6, [1.0]), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (9, [None, 1.0]), (10, [-1.0, 0.0]), (11, [1.0, 0.0])]
    got = found(spark, rows, range(1, 12), 10, dims=2)
    assert {g[0] for g in got} == {1, 2, 3, 10, 11} and all(len([g for g in got if g[0] == q]) == 4 for q in (1, 2, 3, 10, 11))
    assert [(g[2], round(g[3], 6)) for g in got if g[0] == 2] == [(3, 1.0), (1, 0.707107), (11, 0.707107), (10, -0.707107)]
    assert found(spark, [], [1], 3, dims=2) == [] and found(spark, rows[3:5], [4], 3, dims=2) == []
    assert found(spark, rows[:1], [1], 3, dims=2) == []  # nothing but itself


def test_rounds_leave_rings_out(spark):
    """With clustered vectors most rings are never read."""
    rows = clustered(2000, 8, 40, 0.01, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    index = K.build(K.usable(df, "vec_id", "embedding", 8), pivots=64, rings=4)
    seen = []
    real = K.cut_lineage

    def spy(d):
        out = real(d)
        if "place" not in d.columns and {"salts", "limit"} <= set(d.columns):
            seen.append(out.count())
        return out
    K.cut_lineage = spy
    try:
        got = K.search(index, K.usable(df.filter("vec_id % 100 = 0"), "vec_id", "embedding", 8), 5).collect()
    finally:
        K.cut_lineage = real
    assert len(got) == 20 * 5 and sum(seen) < 0.5 * 20 * len(index.rings)


def test_visits_are_worked_out_a_few_queries_at_a_time(spark, monkeypatch):
    """An Arrow batch of queries, each with its vector for every ring it visits, filled a worker's memory."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, K.background_topk(df, df, 3, dims=8, pivots=4, rings=2).collect()))
    monkeypatch.setattr(K, "VISITS", 1)
    assert sorted(map(tuple, K.background_topk(df, df, 3, dims=8, pivots=4, rings=2).collect())) == want and len(want) == 360
