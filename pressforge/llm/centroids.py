"""Centroid clustering by equal-average equal-variance nearest neighbour search.

Vectors are quantised to integers, so every distance, sum and mean is exact and the
result doesn't depend on how the rows are dealt out. For vectors of d components, with
S the component sum and R = sqrt(d * sum of squares - S^2) (d times the deviation),

    d * |x - c|^2  >=  (S_x - S_c)^2                        (equal average)
    d * |x - c|^2  >=  (S_x - S_c)^2 + (R_x - R_c)^2        (equal variance)

Centroids are kept sorted by S. A vector starts at the place of its own S in that order
and scans outward, always on the side that is nearer. When the first bound exceeds the
best distance so far, so do all that follow on that side, and the side is closed; the
second bound rejects single centroids. Whatever is left gets its exact integer distance.
The float square roots have a margin, so a centroid is only ever rejected when it is
surely farther. Ties go to the smaller centroid number.

Every round is one pass over the vectors: tasks add up their vectors by centroid, Spark
adds up the tasks, and ``k`` rows reach the driver. Nothing else is collected or sent:
k * d integers each way, whatever the number of vectors.

Results for odd rows: a vector that is null, has another number of components, or holds
a null, NaN or infinite one is left out. An empty table gives no rows. With fewer than k
vectors there are as many centroids as vectors; repeated rows are clustered (and counted)
each by itself; centroids that start equal share nothing, the smaller number takes all.
Vectors with a null id never start a centroid before the others. Quantised components are
exact up to 2^27 in absolute value (squared distances then fit a long); larger ones raise
an error, as Spark's own integer overflow does. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressforge.session import cut_lineage

LIMIT = 1 << 27


def quantised(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """id, x: floor(scale * component) of every vector with ``dims`` finite components."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda e: F.coalesce(~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    x = F.transform(v, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long"))
    ok = (F.size(v) == dims) & finite
    return vectors.filter(v.isNotNull() & F.coalesce(ok, F.lit(False))).select(F.col(id_col).alias("id"), x.alias("x"))


def seed_hash(seed: int, id_col: str = "id") -> Column:
    """The order in which vectors start centroids."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def starts(x: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The first k vectors by hash of their id (then by id and components)."""
    return [r.x for r in x.select(seed_hash(seed).alias("h"), "id", "x").orderBy(F.col("h").asc_nulls_last(), "id", "x").limit(k).collect()]


class Search:
    """The search over one set of centroids; made once a task."""

    def __init__(self, centroids):
        import numpy as np

        c = np.array(centroids, dtype=np.int64)
        s = c.sum(axis=1)
        self.number = np.lexsort((np.arange(len(c)), s))  # by mean; equal means by number
        self.c, self.s, self.dims = c[self.number], s[self.number], c.shape[1]
        self.r = self.deviation(self.c, self.s)

    def deviation(self, x, s):
        """d * deviation as a float; d * sum of squares - S^2 stays far inside 128 bits, and
        floats of either term are within 2^-52 of it, which ``nearest`` allows for."""
        import numpy as np

        f = x.astype(np.float64)
        return np.sqrt(np.maximum(self.dims * np.einsum("ij,ij->i", f, f) - s.astype(np.float64) ** 2, 0.0))

    def nearest(self, x):
        """number and squared distance (int64) of the nearest centroid of each row of x."""
        import numpy as np

        n, k = len(x), len(self.c)
        s = x.sum(axis=1)
        r = self.deviation(x, s)
        # what rounding can have added to a bound: relative to the squares that were subtracted
        size = np.abs(x).max(axis=1, initial=0).astype(np.float64) + float(np.abs(self.c).max(initial=0)) + 1.0
        slack = 1e-6 * self.dims * size + 1.0
        best = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
        number = np.full(n, -1, dtype=np.int64)
        right = np.searchsorted(self.s, s)
        left = right - 1
        live = np.arange(n)
        while len(live):
            lo, hi = left[live], right[live]
            gap_lo = np.where(lo >= 0, (s[live] - self.s[np.maximum(lo, 0)]).astype(np.float64), np.inf)
            gap_hi = np.where(hi < k, (self.s[np.minimum(hi, k - 1)] - s[live]).astype(np.float64), np.inf)
            down = gap_lo <= gap_hi
            gap = np.where(down, gap_lo, gap_hi)
            limit = self.dims * best[live].astype(np.float64) * (1 + 1e-9) + 1.0
            go = gap * gap <= limit  # the nearer side is beyond the best distance: so is all that is left
            live, down, gap, limit = live[go], down[go], gap[go], limit[go]
            at = np.where(down, left[live], right[live])
            left[live] -= down
            right[live] += ~down
            apart = np.maximum(np.abs(r[live] - self.r[at]) - slack[live], 0.0)
            near = gap * gap + apart * apart <= limit
            rows, at = live[near], at[near]
            diff = x[rows] - self.c[at]
            dist = np.einsum("ij,ij->i", diff, diff)
            name = self.number[at]
            take = (dist < best[rows]) | ((dist == best[rows]) & (name < number[rows]))
            best[rows[take]], number[rows[take]] = dist[take], name[take]
        return number, best


def matrix(batch, dims: int):
    """The vectors of an Arrow batch (column x) as an int64 matrix."""
    import numpy as np

    col = batch.column(batch.schema.get_field_index("x"))
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)
    if x.size and max(-int(x.min()), int(x.max())) > LIMIT:
        raise ArithmeticError(f"a quantised component is beyond {LIMIT}: use a smaller scale")
    return x


def sums(x: DataFrame, centroids: list[list[int]], dims: int) -> list:
    """n and component sums of the vectors nearest to each centroid: k rows at most."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        search, n, total = Search(centroids), np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for b in batches:
            v = matrix(b, dims)
            if not len(v):
                continue
            number, _ = search.nearest(v)
            order = np.argsort(number, kind="stable")
            here, first = np.unique(number[order], return_index=True)
            total[here] += np.add.reduceat(v[order], first, axis=0)
            n += np.bincount(number, minlength=len(centroids))
        on = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(n[on]), pa.array(total[on].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    parts = x.select("x").mapInArrow(run, "cluster long, n long, s array<long>")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dims)]).alias("s")).collect()


def fit(x: DataFrame, k: int, rounds: int, dims: int, seed: int) -> list[list[int]]:
    """k centroids after so many rounds of assignment and floor means; empty ones stay."""
    at = starts(x, k, seed)
    for _ in range(rounds if at else 0):
        new = {r.cluster: [v // r.n for v in r.s] for r in sums(x, at, dims)}
        at = [new.get(i, c) for i, c in enumerate(at)]
    return at


def assign(x: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    """id, cluster, distance (squared) of every vector."""
    kind = x.select("id").schema.simpleString()[7:-1].replace(":", " ")

    def run(batches):
        import pyarrow as pa

        search = Search(centroids)
        for b in batches:
            number, best = search.nearest(matrix(b, dims))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number), pa.array(best)], ["id", "cluster", "distance"])

    if not centroids:  # no vector at all
        return x.select("id", F.lit(0).cast("long").alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
    return x.select("id", "x").mapInArrow(run, f"{kind}, cluster long, distance long")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id_col, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>."""
    x = quantised(vectors, dims, scale, id_col, vector_col)
    at = fit(x, k, rounds, dims, seed)
    found = cut_lineage(assign(x, at, dims))  # ids and two numbers a row: inertia needs all of them first
    per = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    spark = vectors.sparkSession
    about = spark.createDataFrame([(i, per.get(i, 0), sum(per.values()), c) for i, c in enumerate(at)],
                                  "cluster long, cluster_inertia long, inertia long, centroid array<long>")
    return (found.join(F.broadcast(about), "cluster")  # k rows
            .select(F.col("id").alias(id_col), F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid"))


def digests(vectors: DataFrame) -> DataFrame:
    """The query: the final centroid as a sha256 of its decimal components."""
    found = cluster(vectors)
    text = F.array_join(F.transform("centroid", lambda c: c.cast("string")), ",")
    return found.withColumn("centroid_sha256", F.sha2(text, 256)).drop("centroid")
