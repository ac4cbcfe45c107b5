"""N-gram Jaccard join over count vectors in an R-tree.

A document's set holds its distinct shingles of ``size`` words; two documents link
when 100 * intersection >= percent * union. Equal sets are one class from the start.

Candidates. A class's shingles are ordered (those in crowded hash buckets last,
else by hash); linked sets share a shingle among their first
n - ceil(percent * n / 100) + 1 (and two among one more, above 50 percent), so only
those are grouped ("blocks"). Blocks of two or three classes, as chance makes them, name
their pairs, and those that are named once are left: if they link, their second shingle
is in a larger block. The order
needs no more than a bitmap of crowded buckets, of fixed size; any order gives all
links, this one keeps passages that many documents share out of the blocks.

Bound. Shingles are also dealt into groups by hash, about as many groups as
shingles (a power of two, so that points of different sizes compare after adding
up halves). A class is the point of its group counts, and the overlap of two
classes is at most the sum of their coordinate minima. Blocks index their points
in an R-tree; a box's upper corner bounds every point inside, so boxes that can't
reach the overlap needed for a link are left out. Candidates are verified on the
whole texts. Of blocks that hold the same classes one is looked at.

A block of m near copies has m * m / 2 links, but components need only some of
them. So first each class meets the most central class of its blocks, the one
whose shingles are in the fullest blocks, as an original's are among its copies
(bound, then verification). The R-trees then search between classes that are
still in different components; blocks of more than ``cell`` classes are split
into cells that meet pairwise in separate tasks. A pair that shares several
blocks is told by the first it is known to share. No link between components is
lost.

Edge cases: a null text or one without words has no shingle and links with
nothing. Rows without a doc_id link with nothing and have no component. Rows that
share a doc_id are linked by their own texts. Ties: a component is named by its
smallest doc_id. Columns other than doc_id and text are not looked at; ``dedup``
passes them on.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressforge.session import cut_lineage

from .common import WordHashes, as_long, id_filter, maybe_in, mix64, row_key, small_batches, text_bytes
from .components import components

GROUPS = (32, 4096)  # fewest and most groups of a point
TREE_GROUPS = 256
FEW = 8  # blocks that a class carries along, to tell a pair once
FULL = 255  # a group count of so many or more; bounded by the set's size
BUCKET_BITS = 20
LEAF = 32


def shingles(text: bytes, words: WordHashes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle."""
    ws = text.lower().split()
    if not ws:
        return np.zeros(0, dtype=np.uint64)
    h, k = words.of(ws), min(size, len(ws))
    total = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j]
    return np.unique(mix64(total))


def class_of(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def point(s: np.ndarray) -> np.ndarray:
    """Group counts of a set, a byte each."""
    groups = min(GROUPS[1], max(GROUPS[0], 1 << (len(s) - 1).bit_length()))
    return np.minimum(np.bincount(((s >> np.uint64(8)) % np.uint64(groups)).astype(np.int64), minlength=groups), FULL).astype(np.uint8)


def folded(p: np.ndarray) -> np.ndarray:
    """The point in TREE_GROUPS groups at most, for the R-trees."""
    return np.minimum(p.reshape(-1, min(len(p), TREE_GROUPS)).sum(axis=0, dtype=np.int64), FULL).astype(np.uint8)


def packed(p: np.ndarray) -> bytes:
    return zlib.compress(p.tobytes(), 1)


def unpacked(counts: bytes, n: int) -> np.ndarray:
    c = np.frombuffer(zlib.decompress(counts), dtype=np.uint8).astype(np.int64)
    c[c == FULL] = n
    return c


def may_link(x: np.ndarray, nx: int, y: np.ndarray, ny: int, percent: int) -> bool:
    groups = min(len(x), len(y))
    over = np.minimum(x.reshape(-1, groups).sum(axis=0), y.reshape(-1, groups).sum(axis=0)).sum()
    return int(over) >= needed(nx, ny, percent)


def needed(a, b, percent: int):
    """Smallest intersection with which sets of a and b shingles link."""
    return -(-percent * (a + b) // (100 + percent))


def shared_keys(percent: int) -> int:
    """How many shingles of their prefixes two linked classes share at least. Above 50 percent two
    different sets that link have two shingles in common, whatever their size, so prefixes that
    are longer by one share two."""
    return 2 if percent > 50 else 1


def crowded_buckets(docs: DataFrame, size: int) -> np.ndarray:
    """Hash buckets that hold far more classes than others: a mark per bucket."""
    def count(batches):
        words, seen, held, total = WordHashes(), set(), [], np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for b in batches:
            for t in text_bytes(b):
                s = shingles(t, words, size)
                if len(s) and (c := class_of(s)) not in seen:
                    seen.add(c)
                    held.append((s >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
                    if len(held) == 1024:
                        total += np.bincount(np.concatenate(held), minlength=len(total))
                        held = []
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        many = np.flatnonzero(total >= max(8, 6 * total.mean()))
        yield pa.RecordBatch.from_arrays([pa.array(many), pa.array(total[many])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter("n >= 16").select("bucket").collect()
    mark = np.zeros(1 << BUCKET_BITS, dtype=bool)  # at most 2^BUCKET_BITS rows, a megabyte
    mark[[r.bucket for r in rows]] = True
    return mark


def describe(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, k1 (the row), n, node (its class), counts (its point), coarse (the same in fewer groups), prefix (null for copies already met). docs: doc_id, k1, text."""
    crowded = docs.sparkSession.sparkContext.broadcast(crowded_buckets(docs, size))

    def run(batches):
        words, seen, mark = WordHashes(), set(), crowded.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n, node, counts, coarse, prefix = [], [], [], [], []
                for t in text_bytes(part):
                    s = shingles(t, words, size)
                    n.append(len(s))
                    node.append(class_of(s) if len(s) else None)
                    if not len(s) or node[-1] in seen:
                        counts.append(None)
                        coarse.append(None)
                        prefix.append(None)
                        continue
                    seen.add(node[-1])
                    p = point(s)
                    counts.append(packed(p))
                    coarse.append(packed(folded(p)))
                    late = mark[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                    first = np.concatenate([s[~late], s[late]])[:len(s) + (-percent * len(s) // 100) + shared_keys(percent)]
                    prefix.append(as_long(first))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(counts, pa.binary()), pa.array(coarse, pa.binary()),
                                                  pa.array(prefix, pa.list_(pa.int64()))], names=["doc_id", "k1", "n", "node", "counts", "coarse", "prefix"])

    return docs.mapInArrow(run, "doc_id long, k1 long, n long, node long, counts binary, coarse binary, prefix array<long>")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs (a, b) that link. classes: node, rep (doc_id and k1 of a row of it), n, counts; docs: doc_id, k1, text."""
    def bounded(batches):
        for b in batches:
            a, c, na, nc, x, y = (b.column(i).to_pylist() for i in range(6))
            ok = [may_link(unpacked(x[i], na[i]), na[i], unpacked(y[i], nc[i]), nc[i], percent) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    info = classes.select("node", "n", "counts")
    left, right = info.toDF("a", "na", "ca"), info.toDF("b", "nb", "cb")
    close = cut_lineage(pairs.join(left, "a").join(right, "b").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
                        .select("a", "b", "na", "nb", "ca", "cb").mapInArrow(bounded, "a long, b long"))
    nodes = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = cut_lineage(nodes.join(classes.select("node", "rep.doc_id", "rep.k1"), "node"))
    texts = (maybe_in(docs, "k1", id_filter(wanted, "k1")).join(wanted, ["doc_id", "k1"]).groupBy("node").agg(F.first("text").alias("text")))

    def linked(batches):
        words, known = WordHashes(), {}

        def of(node, text):
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                known[node] = shingles(text.encode(), words, size)
            return known[node]

        for b in batches:
            a, c, ta, tc = (b.column(i) for i in range(4))
            ok = []
            for i in range(b.num_rows):
                x, y = of(a[i].as_py(), ta[i].as_py()), of(c[i].as_py(), tc[i].as_py())
                ok.append(len(np.intersect1d(x, y, assume_unique=True)) >= needed(len(x), len(y), percent))
            yield pa.RecordBatch.from_arrays([a, c], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = (close.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))
    return cut_lineage(both.mapInArrow(linked, "a long, b long"))


class RTree:
    """Points (group counts) in boxes of LEAF, boxes in boxes; a box keeps its upper corner and its
    smallest set size."""

    def __init__(self, points: np.ndarray, n: np.ndarray):
        order, cut = np.arange(len(n)), [np.arange(len(n))]
        while max(map(len, cut)) > LEAF:  # halve at the widest coordinate
            halves = []
            for c in cut:
                if len(c) <= LEAF:
                    halves.append(c)
                    continue
                p = points[c]
                c = c[np.argsort(p[:, np.argmax(p.max(axis=0) - p.min(axis=0))], kind="stable")]
                halves += [c[:len(c) // 2], c[len(c) // 2:]]
            cut = halves
        self.order = np.concatenate(cut) if len(n) else order
        self.points, self.n = points[self.order], n[self.order]
        ends = np.cumsum([len(c) for c in cut])
        self.leaves = list(zip(ends - [len(c) for c in cut], ends))
        corner, least = [self.points[a:b].max(axis=0) for a, b in self.leaves], [self.n[a:b].min() for a, b in self.leaves]
        self.levels = [(np.array(corner), np.array(least))]
        while len(self.levels[-1][1]) > LEAF:
            c, m = self.levels[-1]
            at = np.arange(0, len(m), LEAF)
            self.levels.append((np.maximum.reduceat(c, at, axis=0), np.minimum.reduceat(m, at)))

    def search(self, q: np.ndarray, n: int, percent: int) -> np.ndarray:
        """Places of the points whose summed minima with q allow a link."""
        at = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, least = self.levels[depth]
            at = at[np.minimum(corner[at], q).sum(axis=1) >= needed(least[at], n, percent)]
            if depth:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(self.levels[depth - 1][1])]
        if not len(at):
            return at
        i = np.concatenate([np.arange(*self.leaves[j]) for j in at])
        ok = (np.minimum(self.points[i], q).sum(axis=1) >= needed(self.n[i], n, percent)) & (
            np.minimum(self.n[i], n) * 100 >= np.maximum(self.n[i], n) * percent)
        return self.order[i[ok]]


def cell_pairs(points: np.ndarray, n: np.ndarray, asks: np.ndarray, inside: np.ndarray, percent: int):
    """(place in inside, place in asks) of what may link, by an R-tree over the points ``inside``."""
    if len(inside) <= LEAF:  # a single box
        n_in, n_ask = n[inside][:, None], n[asks][None, :]
        over = np.minimum(points[inside][:, None, :], points[asks][None, :, :]).sum(axis=2)
        return np.nonzero((over >= needed(n_in, n_ask, percent)) & (np.minimum(n_in, n_ask) * 100 >= np.maximum(n_in, n_ask) * percent))
    tree = RTree(points[inside], n[inside])
    found = [tree.search(points[q], int(n[q]), percent) for q in asks]
    return np.concatenate(found), np.repeat(np.arange(len(asks)), [len(f) for f in found])


def block_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """rows: key, i, j, side, node, comp, n, coarse, few, sorted by (key, i, j) within a partition.
    Candidate pairs of each cell: between sides 0 and 1, or among all where i = j."""
    def cells(batches):
        held, current = [], None
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(9))):
                if r[:3] != current:
                    if held:
                        yield current, held
                    held, current = [], r[:3]
                held.append(r[3:])
        if held:
            yield current, held

    def run(batches):
        out_a, out_b, size = [], [], 0
        for (key, i, j), rows in cells(batches):
            side, node, comp, n = (np.array([r[c] for r in rows], dtype=np.int64) for c in range(4))
            if (comp == comp[0]).all():
                continue
            points = [unpacked(r[4], r[3]) for r in rows]
            groups = min(map(len, points))
            points = np.stack([p.reshape(-1, groups).sum(axis=0) for p in points])
            every = np.arange(len(n))
            inside, asks = (every, every) if i == j else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            if not len(inside) or not len(asks):
                continue
            x, y = cell_pairs(points, n, asks, inside, percent)
            x, y = inside[x], asks[y]
            ok = comp[x] != comp[y]
            if i == j:
                ok &= node[x] < node[y]
            x, y = x[ok], y[ok]
            first = np.array([not any(k < key and k in rows[c][5] for k in rows[a][5]) for a, c in zip(x.tolist(), y.tolist())], dtype=bool)
            x, y = x[first], y[first]
            out_a.append(np.minimum(node[x], node[y]))
            out_b.append(np.maximum(node[x], node[y]))
            size += len(x)
            if size > 50_000 or len(out_a) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])
                out_a, out_b, size = [], [], 0
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def linked_rows(docs: DataFrame, size: int = 4, percent: int = 85, cell: int = 2048) -> DataFrame:
    """doc_id, k1 (the row), n (its shingles), c (its component; null without a word) for every row of docs."""
    docs = row_key(small_batches(docs).select("doc_id", "text")).select("doc_id", "k1", "text")
    seen = cut_lineage(describe(docs, size, percent))
    classes = cut_lineage(seen.filter("node is not null").groupBy("node")
                          .agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "k1"))).alias("rep"), F.first("n").alias("n"),
                               F.first("counts", ignorenulls=True).alias("counts"), F.first("coarse", ignorenulls=True).alias("coarse"))
                          .filter("rep is not null"))
    # dealt out once, for the count of a block's classes and for what joins it
    rows = seen.select(F.explode("prefix").alias("key"), "node").filter("key is not null").repartition("key")  # the join would ask for it too
    # sums of hashes tell blocks of the same classes; where rounding parts equal ones, both are looked at
    sums = [F.sum(F.shiftright(F.xxhash64("node", F.lit(i)), 28).cast("double")).alias(f"s{i}") for i in (1, 2)]
    blocks = (rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_xor("node").alias("x"), F.count("*").alias("m"), *sums)
              .filter(F.col("lo") != F.col("hi")).groupBy("lo", "hi", "x", "m", "s1", "s2").agg(F.min("key").alias("key"), F.count("*").alias("alike")))
    # blocks of two or three, as chance makes them, name their pairs; one that shares a single block of this
    # kind links only if it also meets in a larger one
    few = F.lit(shared_keys(percent) > 1) & (F.col("m") <= 3)
    mid = F.col("x").bitwiseXOR(F.col("lo")).bitwiseXOR(F.col("hi"))
    named = F.array(F.struct(F.col("lo").alias("a"), F.col("hi").alias("b")), F.struct(F.col("lo").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("hi").alias("b")))
    small = (blocks.filter(few).select(F.inline(F.slice(named, F.lit(1), F.when(F.col("m") == 2, 1).otherwise(3))), "alike").filter("a != b")
             .groupBy("a", "b").agg(F.sum("alike").alias("alike")).filter(F.col("alike") >= shared_keys(percent)))
    large = rows.join(blocks.filter(~few).select("key", (F.col("m") * F.col("alike")).alias("w")), "key").distinct()
    both = cut_lineage(large.select("key", "node", "w", F.lit(False).alias("pair")).union(small.select("a", "b", "alike", F.lit(True))))
    shared, small = both.filter("not pair").drop("pair"), both.filter("pair").select(F.col("key").alias("a"), F.col("node").alias("b"))
    # how full a class's blocks are on average, and its first few blocks
    own = shared.groupBy("node").agg(F.sum("w").alias("w"), F.slice(F.sort_array(F.collect_list("key")), 1, FEW).alias("few"))
    own = cut_lineage(own.join(classes.select("node", "n", "coarse"), "node").select(
        "node", "n", "coarse", "few", (F.col("w") / (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).alias("central")))
    rated = shared.select("key", "node").join(own.select("node", "n", "central"), "node")
    lead = rated.groupBy("key").agg(F.max(F.struct("central", "node", "n")).alias("l")).select("key", F.col("l.node").alias("lead"), F.col("l.n").alias("most"))
    # two classes of too different sizes can't link
    close = F.least("n", "most") * 100 >= F.greatest("n", "most") * percent
    pairs = rated.join(lead, "key").filter((F.col("node") != F.col("lead")) & close).select(F.col("node").alias("a"), F.col("lead").alias("b")).union(small).distinct()
    links = verified(pairs, classes, docs, size, percent)
    linked = components(links)
    # what the first pass left in different components meets in the blocks' R-trees
    placed = (shared.select("key", "node").join(linked, "node", "left")
              .select("key", "node", F.coalesce("component", "node").alias("comp")))
    open_keys = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
                 .filter("lo != hi").select("key", F.ceil(F.col("m") / cell).cast("int").alias("cells")))
    met = (placed.join(open_keys, "key").join(own.drop("central"), "node")
           .withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("cells")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
           .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                   (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "comp", "n", "coarse", "few"))
    cells = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = verified(block_pairs(cells, percent).distinct(), classes, docs, size, percent)
    final = components(links.union(more)).toDF("node", "component")
    return seen.select("doc_id", "k1", "n", "node").join(final, "node", "left").select("doc_id", "k1", "n", F.coalesce("component", "node").alias("c"))


def join(docs: DataFrame, size: int = 4, percent: int = 85, cell: int = 2048) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs."""
    rows = linked_rows(docs, size, percent, cell)
    ids = rows.filter("doc_id is not null and c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return rows.join(ids, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def dedup(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One document of each component (its smallest doc_id; of several rows of that id, the one with
    the smallest key), with docs' own columns. Rows that repeat both id and text stay once; rows
    without an id, and rows without a word, are in no component and stay."""
    rows = linked_rows(docs, size, percent).filter("doc_id is not null and c is not null")
    stays = rows.groupBy("c").agg(F.min(F.struct("doc_id", "k1")).alias("s"))
    gone = rows.join(stays, "c").filter(F.struct("doc_id", "k1") != F.col("s")).select(F.col("doc_id").alias("gone__"), F.col("k1").alias("k1__")).distinct()
    keyed = docs.withColumn("row__", F.xxhash64("doc_id", "text"))  # k1 of row_key
    left = keyed.join(gone, (keyed["doc_id"] == gone["gone__"]) & (keyed["row__"] == gone["k1__"]), "left_anti").drop("row__")
    return left.dropDuplicates(["doc_id", "text"])
