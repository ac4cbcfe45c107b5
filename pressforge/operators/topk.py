"""Exact top-k retrieval by cosine similarity (I3) with a metric index.

On unit vectors the Euclidean distance orders like the cosine (d^2 = 2 - 2 cos), and it
obeys the triangle inequality, which is all the index needs:

* **Cells.** ``pivots`` vectors (a documented sample: the smallest by hash of their id) are
  the centres. Every vector goes to the cell of its nearest pivot, with its distance r
  from it.
* **Rings.** Each cell is cut into ``rings`` by quantiles of r. A vector x in a ring
  [lo, hi] around pivot p can't be nearer to a query q than
  ``max(d(q, p) - hi, lo - d(q, p), 0)``.
* **Rounds.** A query visits its rings in order of that bound, a few in the first round
  and ``GROWTH`` times as many positions in each further one, and skips those whose bound
  is beyond its k-th distance so far. It is done when no ring within that distance is
  left, so the result is exact, whatever the data. How much is skipped depends on how
  clustered the vectors are.

No query meets a vector outside the rings it visits, and there is no all-pairs join: rings
are dealt out in blocks of about ``BLOCK`` vectors (one with a third of all vectors, as
copies make it, in many), the queries that visit a block in groups of the same size, and
only the k best of a block leave its task. The driver holds pivots and ring bounds
(pivots * rings rows, fixed by the parameters) and a count a round.

Vectors that are null, hold a null or non-finite component, have no length or another
number of components than ``dims`` have no cosine and are left out, as queries and as
answers. Similarities are compared to nine decimals, ties by id, so the order doesn't hang
on the order of summation. A query never finds rows of its own id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BLOCK = 2048
VISITS = 32  # queries whose visits are worked out at once
GROWTH = 8
FIRST = 4  # rings of the first round
MARGIN = 1e-6  # more than rounding can move a distance
DIGITS = 9


def usable(df: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """id, vec: the vectors that have a cosine."""
    v = F.col(vec_col)
    ok = F.forall(v, lambda e: F.coalesce(~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    ok = (F.size(v) == dims) & ok & F.exists(v, lambda e: e != 0)
    return df.filter(F.col(id_col).isNotNull() & v.isNotNull() & F.coalesce(ok, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vec"))


def units(vectors):
    """A list of vectors as a matrix of unit rows. Scaled by the largest component first, so
    that squares of tiny or huge components neither vanish nor overflow."""
    import numpy as np

    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def distances(a, b):
    """Euclidean distances between the unit rows of a and b."""
    import numpy as np

    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


@dataclass
class Index:
    vectors: DataFrame  # cell, ring, salt, id, vec
    pivots: list  # unit rows
    rings: list  # (cell, ring, lo, hi, n, salts)


def build(vectors: DataFrame, pivots: int = 128, rings: int = 8) -> Index:
    """vectors: id, vec (from ``usable``). One pass for the cells, one to deal them out."""
    import numpy as np

    spark = vectors.sparkSession
    sample = vectors.orderBy(F.xxhash64("id"), "id", "vec").limit(pivots).select("vec").collect()  # ``pivots`` rows
    if not sample:
        return Index(vectors.select(*[F.lit(0).cast("long").alias(c) for c in ("cell", "ring", "salt")], "id", "vec"), [], [])
    centres = units([r.vec for r in sample])

    def assign(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            d = distances(units(b.column(1).to_pylist()), centres)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(d[np.arange(len(d)), cell]), b.column(0), b.column(1)], ["cell", "r", "id", "vec"])

    placed = cut_lineage(vectors.select("id", "vec").mapInArrow(assign, "cell long, r double, id long, vec array<double>"))
    cuts = placed.groupBy("cell").agg(F.percentile_approx("r", [i / rings for i in range(1, rings)] or [1.0], 1000).alias("cuts"))
    ring = F.size(F.filter("cuts", lambda c: c < F.col("r"))).cast("long")
    placed = placed.join(F.broadcast(cuts), "cell").withColumn("ring", ring).drop("cuts")  # a row a pivot
    stats = placed.groupBy("cell", "ring").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count(F.lit(1)).alias("n"))
    stats = stats.withColumn("salts", F.ceil(F.col("n") / BLOCK).cast("long"))
    rows = [tuple(r) for r in stats.orderBy("cell", "ring").collect()]  # pivots * rings rows at most
    salts = spark.createDataFrame([(c, g, s) for c, g, *_, s in rows], "cell long, ring long, salts long")
    dealt = placed.join(F.broadcast(salts), ["cell", "ring"]).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    return Index(dealt.select("cell", "ring", "salt", "id", "vec"), centres.tolist(), rows)


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """query, rank, neighbour, score for every query (id, vec). A query has as many rows as
    there are other vectors, k at most."""
    import numpy as np

    spark = queries.sparkSession
    empty = spark.createDataFrame([], "query long, rank int, neighbour long, score double")
    if not index.rings:
        return empty
    centres = np.array(index.pivots)
    cells, lo, hi = (np.array([r[i] for r in index.rings]) for i in (0, 2, 3))
    table = spark.createDataFrame([(i, r[0], r[1], r[5]) for i, r in enumerate(index.rings)], "place long, cell long, ring long, salts long")
    # a query may be given more than once; each is a row of its own here and in the result
    state = cut_lineage(queries.select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("query"), "vec",
                                       F.lit(None).cast("array<struct<score:double,neighbour:long>>").alias("best")))

    def visits(start: int, stop: int):
        """row, query, vec, limit (the similarity to beat), place: the rings at positions [start, stop) that may hold a better one."""
        def run(batches):
            import pyarrow as pa

            # few queries at a time: one may visit every ring, and takes its vector along each time
            for b in (b.slice(at, VISITS) for b in batches for at in range(0, b.num_rows, VISITS)):
                d = distances(units(b.column(2).to_pylist()), centres)[:, cells]
                bound = np.maximum(np.maximum(d - hi, lo - d), 0.0)
                order = np.argsort(bound, axis=1, kind="stable")
                limit = np.array([x[-1]["score"] if x and len(x) == k else -np.inf for x in b.column(3).to_pylist()])
                reach = np.sqrt(np.maximum(2.0 - 2.0 * (np.maximum(limit, -1.0) - 10.0 ** -DIGITS), 0.0)) + MARGIN
                reach[np.isinf(limit)] = np.inf  # not k rows yet
                position = np.arange(len(cells))[None, :]
                take = (position >= start) & (position < stop)
                take = take & (np.take_along_axis(bound, order, axis=1) <= reach[:, None])
                row, at = np.nonzero(take)
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(row)) for i in range(3)), pa.array(limit[row]), pa.array(order[row, at].astype(np.int64))],
                                                 ["row", "query", "vec", "limit", "place"])

        return state.select("row", "query", "vec", "best").mapInArrow(run, "row long, query long, vec array<double>, limit double, place long")

    def best_of_block(there, asked):
        import pandas as pd

        if not len(there) or not len(asked):
            return pd.DataFrame({"row": [], "neighbour": [], "score": []})
        score = np.round(units(asked["vec"]) @ units(there["vec"]).T, DIGITS) + 0.0
        ids = there["id"].to_numpy()
        score[asked["query"].to_numpy()[:, None] == ids[None, :]] = -np.inf
        score[score < asked["limit"].to_numpy()[:, None]] = -np.inf
        out = []
        for i, row in enumerate(asked["row"].to_numpy()):
            at = np.flatnonzero(score[i] > -np.inf)
            at = at[np.lexsort((ids[at], -score[i][at]))][:k]
            out.append(pd.DataFrame({"row": row, "neighbour": ids[at], "score": score[i][at]}))
        return pd.concat(out)

    start, stop = 0, FIRST
    while start < len(index.rings):
        asked = visits(start, stop).join(F.broadcast(table), "place").drop("place")  # pivots * rings rows
        asked = cut_lineage(asked)
        groups = asked.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("asked")).withColumn("groups", F.ceil(F.col("asked") / BLOCK).cast("long")).drop("asked")
        there = index.vectors.join(groups, ["cell", "ring"]).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")
        asked = (asked.join(groups, ["cell", "ring"]).withColumn("group", F.pmod(F.xxhash64("row"), F.col("groups"))).drop("groups")
                 .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts"))
        key = ["cell", "ring", "salt", "group"]
        found = there.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(best_of_block, "row long, neighbour long, score double")
        old = state.filter("best is not null").select("row", F.inline("best"))
        state = cut_lineage(state.drop("best").join(top(found.unionByName(old.select("row", "neighbour", "score")), k), "row", "left"))
        start, stop = stop, stop * GROWTH
        # every query has visited its first ``start`` rings; is one left that could matter?
        if start >= len(index.rings) or not visits(start, len(index.rings)).limit(1).count():
            break
    return state.select("query", F.posexplode("best").alias("pos", "b")).select(
        "query", (F.col("pos") + 1).alias("rank"), F.col("b.neighbour").alias("neighbour"), F.col("b.score").alias("score"))


def top(found: DataFrame, k: int) -> DataFrame:
    """row, best: the k best of each row, best first. Tasks cut their own part to k before the shuffle."""
    from pyspark.sql import Window

    w = Window.partitionBy("row").orderBy(F.col("score").desc(), "neighbour")
    cut = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    one = cut.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "neighbour"))).alias("b"))  # k entries
    return one.select("row", F.transform("b", lambda x: F.struct(x["score"].alias("score"), x["neighbour"].alias("neighbour"))).alias("best"))


def background_topk(df: DataFrame, queries: DataFrame, k: int = 10, dims: int = 64, id_col: str = "vec_id", vec_col: str = "embedding",
                    pivots: int = 128, rings: int = 8) -> DataFrame:
    """The k most similar vectors of ``df`` for every row of ``queries``."""
    index = build(usable(df, id_col, vec_col, dims), pivots, rings)
    return search(index, usable(queries, id_col, vec_col, dims), k)
