"""Scene walk (F1): a bijection per lap, any sizes, and a pool without a distinct step."""
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressforge.operators import walk as W
from pressforge.operators.scenes import with_validity
from pressforge.session import cut_lineage

SMALL = W.SceneSpace(roles=["r1", "r2", "r3"], events=["opens a clinic", "e2"], normal=["in a hospital corridor"], absurd=["a1", "a2", "a3", "a4"], shots=["s1", "s2"])


def test_every_lap_is_a_permutation(spark):
    n = SMALL.size
    d = spark.range(3 * n).withColumnRenamed("id", "i")
    rows = W.decoded(W.permuted(d, "i", SMALL.sides, 7), SMALL).collect()
    laps = {}
    for r in rows:
        assert r.lap == r.i // n and r.mismatch == (r.back_raw in SMALL.absurd)
        laps.setdefault(r.lap, []).append((r.i, r.scene, (r.role, r.event, r.back_raw, r.shot)))
    for lap in laps.values():
        assert sorted(s for _, s, _ in lap) == list(range(n)) and len({c for *_, c in lap}) == n
    orders = [[s for _, s, _ in sorted(lap)] for lap in laps.values()]
    assert orders[0] != orders[1] != orders[2] != orders[0]  # another order in each lap
    assert len({a - b for a, b in zip(orders[0], orders[0][1:])}) > n // 3  # no arithmetic sequence


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(0, 2**31), st.integers(0, 3), st.integers(1, 7))
def test_rounds_can_be_undone(a, b, seed, lap, rounds):
    """unwalk is the inverse in plain Python, so the walk is one to one for any sizes."""
    seen = {W.unwalk(left, right, lap, (a, b), seed, rounds) for left in range(a) for right in range(b)}
    assert seen == set(range(lap * a * b, (lap + 1) * a * b))


def test_unwalk_matches_columns(spark):
    d = spark.range(10_000).withColumnRenamed("id", "i")
    space = W.SceneSpace()
    for r in W.permuted(d, "i", space.sides, 7).sample(0.02, seed=1).collect():
        assert W.unwalk(r.left, r.right, r.lap, space.sides, 7) == r.i


def test_pool_is_valid_and_distinct(spark):
    p = W.walk_pool(spark, 500, 3)
    rows = p.collect()
    assert len(rows) == 500 == len({r.scene for r in rows}) == len({r.position for r in rows})
    lap = W.decoded(W.permuted(spark.range(W.SceneSpace().size).withColumnRenamed("id", "position"), "position", W.SceneSpace().sides, 3), W.SceneSpace())
    lap = cut_lineage(lap.drop("valid"))  # validity by searching the texts, as the scene plan does it
    first = with_validity(lap).filter("valid").orderBy("position").limit(500).select("position").collect()
    assert sorted(r.position for r in rows) == [r.position for r in first]
    assert W.walk_pool(spark, 0, 3).count() == 0
    with pytest.raises(ValueError):
        W.walk_pool(spark, SMALL.size + 1, 3, SMALL)
    with pytest.raises(ValueError):
        W.SceneSpace(roles=[])


def test_sparse_orders_walk_without_gaps(spark):
    d = spark.createDataFrame([(i * 10**12 + 5, i) for i in range(SMALL.size)], "accept_order long, k long")
    got = W.walk(d, 9, SMALL).agg(F.count_distinct("scene"), F.max("lap")).first()
    assert tuple(got) == (SMALL.size, 0)
