"""First-wins deduplication (H1-H3, F4, M2 batch side).

Exact dedup is an aggregation (``min`` of a struct led by the arrival order)
by a 128-bit digest of the key, so a caption repeated by a third of all rows is
folded map-side before the shuffle instead of landing in one window partition.

Greedy near-duplicate dedup (H2/H3) is order-dependent and not transitive:
a row is dropped iff it conflicts with an earlier *kept* row. It runs as
rounds over the conflict structure only; see ``greedy_keep``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def digest_of(keys: list[str]) -> list:
    """128 bits of the key columns, nulls apart from everything else."""
    cols = [F.col(k) for k in keys]
    return [F.xxhash64(*cols), F.xxhash64(F.lit("again"), *cols, *[c.isNull() for c in cols])]


def first_wins(df: DataFrame, keys: list[str], order_col: str = "accept_order") -> DataFrame:
    """H1: keep the earliest row per key (ties impossible: order is unique).

    Rows are grouped by 128 bits of the key, so tasks sort and compare two numbers, not texts."""
    others = [c for c in df.columns if c != order_col]
    a, b = digest_of(keys)
    agg = df.groupBy(a.alias("_a"), b.alias("_b")).agg(F.min(F.struct(order_col, *others)).alias("_r"))
    return agg.select("_r.*").select(*df.columns)


def anti_seen(new: DataFrame, seen: DataFrame, col: str = "text") -> DataFrame:
    """Rows whose ``col`` was not accepted before (null-safe)."""
    s = seen.select(F.col(col).alias("_seen")).distinct()
    return new.join(s, new[col].eqNullSafe(s["_seen"]), "left_anti")


def _least(cols):
    return cols[0] if len(cols) == 1 else F.least(*cols)


def greedy_keep(nodes: DataFrame, order_col: str, groups: list[tuple[str, DataFrame | None]],
                max_rounds: int = 10_000) -> DataFrame:
    """Greedy first-wins selection under several conflict relations.

    ``nodes``: one row per candidate with a unique integer ``order_col`` and
    one column per relation holding the row's group value.
    ``groups``: list of (column, neighbour_edges). Two rows conflict under a
    relation if their values are equal, or if (a, b) is in the edge table
    ``neighbour_edges(a, b)`` (symmetric, both directions present). ``None``
    means equality only.

    A row is kept iff no earlier kept row conflicts with it. Each round works
    on aggregates per group value (never on row pairs): for every value the
    smallest kept / undecided arrival among itself and its neighbours. Rows
    with no earlier undecided or kept conflict are decided at once; lineage is
    cut every round with a reliable checkpoint.

    Rows without any conflict (their value is unique in every relation and
    has no neighbour) are kept up front; only the conflicted rest iterates.

    Returns ``nodes`` plus boolean ``kept``.
    """
    cols = nodes.columns
    groups = [(g, None if e is None else cut_lineage(e)) for g, e in groups]  # read twice below
    flags = nodes
    for gi, (gcol, edges) in enumerate(groups):
        cnt = nodes.groupBy(gcol).agg(F.count(F.lit(1)).alias(f"_n{gi}"))
        flags = flags.join(cnt, gcol, "left")
        if edges is not None:
            nb = edges.select(F.col("a").alias(gcol)).distinct().withColumn(f"_e{gi}", F.lit(True))
            flags = flags.join(nb, gcol, "left")
    alone = None
    for gi, (gcol, edges) in enumerate(groups):
        c = F.col(f"_n{gi}") == 1
        if edges is not None:
            c = c & F.col(f"_e{gi}").isNull()
        c = c | F.col(gcol).isNull()  # a NULL value (unreadable) conflicts with nothing
        alone = c if alone is None else (alone & c)
    # edges are read every round: computed once, and only those between rows that iterate
    flags = cut_lineage(flags.withColumn("_alone", alone).select(*cols, "_alone"))
    free = flags.filter(F.col("_alone")).select(*cols).withColumn("kept", F.lit(True))
    nodes = flags.filter(~F.col("_alone")).select(*cols)
    groups = [(g, None if e is None else _between(e, nodes.select(F.col(g).alias("v")).distinct())) for g, e in groups]
    return free.unionByName(_greedy_rounds(nodes, order_col, groups, max_rounds))


def _between(edges: DataFrame, values: DataFrame) -> DataFrame:
    e = edges.join(values, edges.a == values.v, "left_semi")
    return cut_lineage(e.join(values, e.b == values.v, "left_semi").select("a", "b"))


def _greedy_rounds(nodes: DataFrame, order_col: str, groups, max_rounds: int) -> DataFrame:
    """One checkpoint a round, of the rows that were undecided; what was kept before is read from
    the checkpoints of earlier rounds."""
    big = F.lit(2 ** 62).cast("bigint")
    und, done, kept = nodes, [], None
    for _ in range(max_rounds):
        rated = und
        for gi, (gcol, edges) in enumerate(groups):
            seen = und.groupBy(gcol).agg(F.min(order_col).alias("_u")).withColumn("_k", F.lit(None).cast("bigint"))
            if kept is not None:  # the smallest kept arrival of each value
                seen = seen.unionByName(kept.groupBy(gcol).agg(F.min(order_col).alias("_k")).withColumn("_u", F.lit(None).cast("bigint")))
            if edges is not None:
                near = edges.join(seen.withColumnRenamed(gcol, "b"), "b").select(F.col("a").alias(gcol), "_u", "_k")
                seen = seen.unionByName(near)
            seen = seen.groupBy(gcol).agg(F.min("_k").alias(f"_k{gi}"), F.min("_u").alias(f"_u{gi}"))
            rated = rated.join(seen, gcol, "left")
        kmin = _least([F.coalesce(F.col(f"_k{gi}"), big) for gi in range(len(groups))])
        umin = _least([F.coalesce(F.col(f"_u{gi}"), big) for gi in range(len(groups))])
        o = F.col(order_col)
        verdict = F.when(kmin < o, F.lit(2)).when(umin < o, F.lit(0)).otherwise(F.lit(1))
        rated = cut_lineage(rated.withColumn("_st", verdict).select(*nodes.columns, "_st"))
        done.append(rated.filter("_st != 0"))
        und = rated.filter("_st = 0").drop("_st")
        new = rated.filter("_st = 1").drop("_st")
        kept = new if kept is None else kept.unionByName(new)
        if not und.limit(1).count():
            break
    else:
        raise RuntimeError("greedy_keep did not converge")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumn("kept", F.col("_st") == 1).drop("_st")
