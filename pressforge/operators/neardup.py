"""64-bit fingerprints and exact near-duplicate joins.

Hamming distance <= k is found with a banded equi-join that is exact by the
pigeonhole principle: split the 64 bits into m >= k+1 bands; two hashes
within distance k agree on at least m-k bands, so they share the key
(combo, hash & mask(combo)) for some combination of m-k bands. Each distinct
hash is replicated C(m, k) times (20 for the default m = 6, k = 3); larger m
gives finer keys (fewer candidates per key) at a higher replication.

Work is done on *distinct* hash values: a value copied by a third of all rows
is one row here, so copies never turn into a quadratic pair list.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V


BANDS = 6  # 20 keys of about 32 bits for distance 3; 7 (35 keys of about 37) suits the largest sets


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >= (1 << 63) else x


def band_masks(m: int) -> list[int]:
    """m contiguous bands covering bits 0..63 (as unsigned ints)."""
    edges = [round(i * 64 / m) for i in range(m + 1)]
    return [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(m)]


def combo_masks(k: int, m: int) -> list[int]:
    bands = band_masks(m)
    out = []
    for combo in combinations(range(m), m - k):
        mask = 0
        for b in combo:
            mask |= bands[b]
        out.append(_signed(mask))
    return out


def fingerprint64(vec: Column, n: int = 64) -> Column:
    """Bit i set when v[i] is above the median of the n values.
    (Re-aimed perceptual hash: works on a 64-value feature vector.)"""
    s = F.sort_array(vec.cast("array<double>"))
    med = (F.element_at(s, n // 2) + F.element_at(s, n // 2 + 1)) / F.lit(2.0)
    bits = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.when(F.element_at(vec, i + 1).cast("double") > med,
                                        F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def add_fingerprint(df: DataFrame, vec: str, out: str = "h", n: int = 64) -> DataFrame:
    """K11 with the median computed once per row (its own column), so the
    64-way bit lambda only reads it."""
    s = F.sort_array(F.col(vec).cast("array<double>"))
    d = df.withColumn("_med", (F.element_at(s, n // 2) + F.element_at(s, n // 2 + 1)) / F.lit(2.0))
    bits = F.transform(F.col(vec), lambda x, i: F.when(x.cast("double") > F.col("_med"),
                                                       F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
                       .otherwise(F.lit(0).cast("bigint")))
    return d.withColumn(out, F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))).drop("_med")


def hamming(a: Column, b: Column) -> Column:
    """K12."""
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def _keyed(hv: DataFrame, col: str, masks: list[int], sfx: str) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("c"), F.col(col).bitwiseAND(F.lit(mk)).alias("k"))
                     for i, mk in enumerate(masks)])
    return hv.select(col, F.explode(keys).alias("_ck")).select(
        col, F.col("_ck.c").alias(f"c{sfx}"), F.col("_ck.k").alias(f"k{sfx}"))


def band_keys(df: DataFrame, col: str, k: int = V.PHASH_DISTANCE_MAX, bands: int = BANDS) -> DataFrame:
    """h, k: the 64-bit keys under which a near hash can be found, for every distinct hash of ``df``.
    Hashes within distance ``k`` share at least one."""
    hv = df.select(F.col(col).alias("h")).where(F.col("h").isNotNull()).distinct()
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("h").bitwiseAND(F.lit(m))) for i, m in enumerate(combo_masks(k, bands))])
    return hv.select("h", F.explode(keys).alias("k"))


def _first_combo(x: Column, masks: list[int]) -> Column:
    """Index of the first band combination on which the two hashes agree."""
    e = None
    for i, mk in enumerate(masks):
        cond = x.bitwiseAND(F.lit(mk)) == 0
        e = F.when(cond, F.lit(i)) if e is None else e.when(cond, F.lit(i))
    return e


def near_pairs(a: DataFrame, b: DataFrame | None = None, col: str = "h", k: int = V.PHASH_DISTANCE_MAX,
               bands: int = BANDS) -> DataFrame:
    """distinct hash-value pairs within Hamming distance ``k``.

    Self-join when ``b`` is None (pairs with ha < hb); otherwise all (ha, hb)
    with ha from ``a`` and hb from ``b``. Exact for any band count; every pair
    is emitted once (only from the first band combination it agrees on)."""
    av = a.select(F.col(col).alias("ha")).where(F.col("ha").isNotNull()).distinct()
    bv = (b if b is not None else a).select(F.col(col).alias("hb")).where(F.col("hb").isNotNull()).distinct()
    m = bands
    if m < k + 1:
        raise ValueError("need at least k+1 bands for an exact join")
    masks = combo_masks(k, m)
    ka = _keyed(av, "ha", masks, "a")
    kb = _keyed(bv, "hb", masks, "b")
    x = F.col("ha").bitwiseXOR(F.col("hb"))
    cond = ((F.col("ca") == F.col("cb")) & (F.col("ka") == F.col("kb")) & (F.bit_count(x) <= k)
            & (_first_combo(x, masks) == F.col("ca")))
    if b is None:
        cond = cond & (F.col("ha") < F.col("hb"))
    # the keys are C(m, k) rows a hash, which the planner's sizes don't count: without the hint it would
    # broadcast them for what the hashes alone measure
    j = ka.join(kb.hint("merge"), cond)
    return j.select("ha", "hb", hamming(F.col("ha"), F.col("hb")).alias("dist"))


def near_dup_anti(new: DataFrame, stored: DataFrame, col: str = "h", k: int = V.PHASH_DISTANCE_MAX,
                  bands: int = BANDS) -> DataFrame:
    """rows of ``new`` whose hash is not within ``k`` of any stored hash
    (NULL hashes are unreadable images and pass)."""
    hit = near_pairs(new, stored, col, k, bands).select(F.col("ha").alias("_h")).distinct()
    return new.join(hit, new[col] == hit["_h"], "left_anti")


def neighbour_edges(pairs: DataFrame) -> DataFrame:
    """Symmetric (a, b) edge list from (ha, hb) pairs, for ``greedy_keep``. The pairs are read once: a
    union of both directions would join them twice."""
    both = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in (("ha", "hb"), ("hb", "ha"))]
    return pairs.select(F.inline(F.array(*both)))
