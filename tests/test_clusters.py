"""Clusters by contraction (P1) against plain Python."""
import random

from pressforge.operators import clusters as C
from pressforge.operators.neardup import near_pairs


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def found(spark, edges):
    return {r.node: r.cluster for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}


def test_shapes(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(0, 60)]
    rng.shuffle(path)
    shuffled = list(range(200, 240))
    rng.shuffle(shuffled)
    chain = list(zip(shuffled, shuffled[1:]))  # a path whose numbers go up and down
    star = [(500, i) for i in range(400, 450)] + [(300, i) for i in range(301, 330)]
    some = [(rng.randint(1000, 1150), rng.randint(1000, 1150)) for _ in range(90)]
    odd = [(7, 7), (None, 1), (2, None), (-5, 9000), (-5, 9000), (9000, -5)]
    edges = path + chain + star + some + odd
    rng.shuffle(edges)
    assert found(spark, edges) == brute(edges)
    assert found(spark, [(1, 1)]) == {} and found(spark, []) == {}


def test_no_near_pair_straddles_a_split(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        h = rng.getrandbits(63)
        for j in range(rng.randint(1, 5)):
            rows.append((len(rows), h))
            h ^= (1 << rng.randint(0, 62)) | (1 << rng.randint(0, 62))
    rows += [(10_000 + i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, h long")
    out = C.split_near(df, 7).collect()
    assert len(out) == len(rows)
    split = {}
    for r in out:
        if r.h is not None:
            split.setdefault(r.h, set()).add(r.split)
    for p in near_pairs(df).collect():
        assert split[p.ha] == split[p.hb] and len(split[p.ha]) == 1
    assert {r.split for r in out} == {"train", "validation", "test"}
    assert len({r.split for r in out if r.h is None}) == 1
