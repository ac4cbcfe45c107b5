"""Centroid clustering against exact integers in plain Python, and on awkward tables."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressforge.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=16, rounds=3, dims=64, scale=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) by exact integers."""
    kept = [(i, [math.floor(scale * float(np.float32(e))) for e in v]) for i, v in rows
            if v is not None and len(v) == dims and all(e is not None and math.isfinite(e) for e in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    at = [x for _, x in first[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        by = {}
        for _, x in kept:
            by.setdefault(nearest(x)[1], []).append(x)
        at = [[sum(col) // len(col) for col in zip(*by[n])] if n in by else c for n, c in enumerate(at)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    per = {}
    for _, n, d in found:
        per[n] = per.get(n, 0) + d
    return sorted((str(i), n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, at[n])).encode()).hexdigest()) for i, n, d in found)


def result(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    out = centroids.digests(df)
    assert result(out) == brute(rows)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and dict(out.dtypes)["cluster"] == "int"


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 6), st.integers(0, 2**32), st.sampled_from([1, 3, 40, 10**4, centroids.LIMIT - 1]), st.integers(1, 20))
def test_search_is_exact(dims, seed, size, k):
    """Any vectors and centroids, equal sums and equal centroids included."""
    rng = np.random.default_rng(seed)
    c, x = rng.integers(-size, size + 1, (k, dims)), rng.integers(-size, size + 1, (60, dims))
    x[:5] = c[rng.integers(0, k, 5)]
    number, best = centroids.Search(c.tolist()).nearest(x)
    for v, n, d in zip(x.tolist(), number, best):
        assert (d, n) == min((sum((a - b) ** 2 for a, b in zip(v, y)), j) for j, y in enumerate(c.tolist()))


def test_search_rejects_most(monkeypatch):
    """The bounds spare exact distances when means and deviations differ."""
    rng = np.random.default_rng(1)
    c = rng.normal(size=(400, 32)) * rng.uniform(1, 200, (400, 1)) + rng.normal(scale=400, size=(400, 1))
    x = (c[rng.integers(0, 400, 500)] + rng.normal(size=(500, 32))).astype(np.int64)
    search, exact, einsum = centroids.Search(c.astype(np.int64).tolist()), [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: exact.append(len(a)) or einsum(how, a, b))
    number, best = search.nearest(x)
    assert sum(exact) < 0.05 * 400 * 500
    assert (best == np.array([min(((v - y) ** 2).sum() for y in c.astype(np.int64)) for v in x])).all()


def test_awkward_rows(spark):
    one = [0.5] * 64
    rows = [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 63 + [None]), (5, [float("nan")] + one[1:]), (6, [float("inf")] + one[1:]), (7, [-float("inf")] + one[1:]),
            (8, one), (8, one), (9, one), (None, [0.0] * 64), (10, [-0.01] * 64), (11, [1e5] * 64), (8, [2.0] * 64)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumns({c: F.lit(c) for c in ("id", "x", "cluster", "distance", "centroid", "n", "s")})
    assert result(centroids.digests(df)) == brute(rows)  # fewer vectors than centroids, equal centroids, ties
    assert centroids.digests(df.limit(0)).collect() == []
    assert centroids.digests(df.filter("vec_id < 8")).collect() == []
    with pytest.raises(Exception, match="smaller scale"):
        centroids.digests(spark.createDataFrame([(1, [3e38] * 64, 0)], SCHEMA)).collect()


def test_any_partitioning(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert result(centroids.digests(df.repartition(7))) == result(centroids.digests(df.coalesce(1)))
