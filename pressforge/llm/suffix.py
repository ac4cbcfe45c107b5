"""Exact substring dedup by a hash-compared suffix sort.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else
(in any document, or elsewhere in the same one) is removed; matches never cross
documents, and what repeats is judged on the input.

Routing. Of each window of LENGTH bytes the GRAM-byte piece with the smallest hash
is its anchor (the first of equal ones), so equal windows have equal anchors at
equal places. Consecutive windows with one anchor are a run. Runs are grouped by
anchor over the whole corpus; an anchor that occurs once needs no further look.
Runs equal as a whole (anchor hash and a second hash of all their bytes) are
counted; all windows of those that occur twice or more repeat. A text that occurs
more than once repeats as a whole, so each text is looked at once a task.

Sorting. Where the runs of an anchor differ, one of each kind sends its bytes to
the anchor's task. There their suffixes, one for each window, are merge-sorted.
Two suffixes are compared by their longest common extension, found by binary
search over prefix polynomial hashes; suffixes that agree in LENGTH bytes are
ties, and ties are verified byte by byte. A suffix with a tie repeats.
Anchors with more than ``wide`` kinds of runs are not sorted in one task: their
windows are counted by a 128-bit hash, one row each.

Edge cases: a null or empty text has no bytes and keeps none (hash of ""). Texts
under LENGTH bytes stay whole. Rows that repeat a doc_id and text are separate
occurrences, so both lose what they share. Columns other than doc_id and text are
not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressforge.session import cut_lineage

from .common import as_long, id_filter, maybe_in, mix64, small_batches, text_bytes

LENGTH, GRAM = 200, 48
BUFFER = 1 << 17  # bytes looked at together
PLACE_BITS = 20
BASE = 0x5851F42D4C957F2D  # odd: it has an inverse modulo 2^64


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as many as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int):
        if len(self.up) < n:
            both = []
            for b in (BASE, pow(BASE, -1, 1 << 64)):
                x = np.full(n, b, dtype=np.uint64)
                x[0] = 1
                both.append(np.multiply.accumulate(x))
            self.up, self.down = both
        return self.up, self.down

    def prefixes(self, buf: np.ndarray) -> np.ndarray:
        """Prefix polynomial hashes: entry i is that of the first i bytes."""
        out = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.of(len(buf) + 1)[0][:len(buf)], out=out[1:])
        return out

    def hashes(self, prefix: np.ndarray, at: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` bytes from each place, whatever the place."""
        return (prefix[at + length] - prefix[at]) * self.down[at]


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours: running minima from both ends of blocks of w."""
    n = len(a) - w + 1
    blocks = np.full(-(-len(a) // w) * w, np.iinfo(a.dtype).max, dtype=a.dtype)
    blocks[:len(a)] = a
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def buffers(texts: list[bytes]):
    """(bytes, [(text number, place in the text, place in the buffer, length)]): texts side by side, long
    ones in pieces that overlap so that each window lies in one piece."""
    held, pieces, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - LENGTH + 1, 0), BUFFER):
            piece = t[at:at + BUFFER + LENGTH - 1]
            if held and size + len(piece) > BUFFER + LENGTH:
                yield b"".join(held), pieces
                held, pieces, size = [], [], 0
            held.append(piece)
            pieces.append((i, at, size, len(piece)))
            size += len(piece)
    if held:
        yield b"".join(held), pieces


def anchor_runs(data: bytes, pieces: list, powers: Powers):
    """first window (place in data), windows, anchor's place, anchor's hash, piece number, for each run."""
    buf = np.frombuffer(data, dtype=np.uint8)
    prefix = powers.prefixes(buf)
    h = mix64(powers.hashes(prefix, np.arange(len(buf) - GRAM + 1), GRAM))
    packed = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(packed, LENGTH - GRAM + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), [p[3] for p in pieces])
    inside = piece[:len(anchor)] == piece[LENGTH - 1:]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (piece[1:len(anchor)] != piece[:len(anchor) - 1]) | (inside[1:] != inside[:-1])]))
    windows = np.diff(np.append(new, len(anchor)))
    ok = inside[new]
    new, windows = new[ok], windows[ok]
    return new, windows, anchor[new], h[anchor[new]], piece[new]


def place(s, reps, windows, off):
    """First byte, equal runs in a row (as in a text that repeats a word), windows of each, anchor's offset."""
    return (s << 34) | (reps << 16) | (windows << 8) | off


def place_parts(at):
    return at >> 34, (at >> 16) & 0x3FFFF, (at >> 8) & 255, at & 255


def place_columns(c: str):
    return F.shiftright(c, 34), F.shiftright(c, 16).bitwiseAND(0x3FFFF), F.shiftright(c, 8).bitwiseAND(255), F.col(c).bitwiseAND(255)


def run_rows(keyed: DataFrame, full: bool) -> DataFrame:
    """anchor of each run and how many (c); if ``full`` with seg (hash of its bytes), k1 and place. keyed: k1, text."""
    names = ["anchor", "c", "seg", "k1", "place"] if full else ["anchor", "c"]

    def rows_of(data, pieces, keys, powers):
        import xxhash

        first, windows, x, h, piece = anchor_runs(data, pieces, powers)
        if not full:
            h, c = np.unique(h, return_counts=True)
            return [as_long(h), c]
        view = memoryview(data)
        seg = np.fromiter((xxhash.xxh3_64_intdigest(view[i:i + m + LENGTH - 1]) for i, m in zip(first.tolist(), windows.tolist())), dtype=np.uint64, count=len(first))
        again = (h[1:] == h[:-1]) & (seg[1:] == seg[:-1]) & (piece[1:] == piece[:-1]) & (first[1:] == first[:-1] + windows[:-1])
        head = np.flatnonzero(np.concatenate([[True], ~again])) if len(h) else np.zeros(0, dtype=np.int64)
        reps = np.diff(np.append(head, len(h)))
        first, windows, x, h, piece, seg = (v[head] for v in (first, windows, x, h, piece, seg))
        shift = np.array([p[1] - p[2] for p in pieces], dtype=np.int64)
        key = np.array([keys[p[0]] for p in pieces], dtype=np.int64)
        return [as_long(h), reps, as_long(seg), key[piece], place(first + shift[piece], reps, windows, x - first)]

    def run(batches):
        powers, seen = Powers(), set()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                keys, texts = part.column(0).to_pylist(), text_bytes(part)
                for i, k in enumerate(keys):
                    if k in seen:
                        texts[i] = b""
                    seen.add(k)
                for data, pieces in buffers(texts):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows_of(data, pieces, keys, powers)], names=names)

    return keyed.select("k1", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


class SuffixSorter:
    """Merge sort of suffixes of a buffer, within classes, comparing LENGTH bytes at most."""

    def __init__(self, buf: np.ndarray, powers: Powers):
        self.buf, self.powers, self.prefix = buf, powers, powers.prefixes(buf)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension (up to LENGTH) of the suffixes at i and j, by binary search."""
        lo = np.zeros(len(i), dtype=np.int64)
        same = self.powers.hashes(self.prefix, i, LENGTH) == self.powers.hashes(self.prefix, j, LENGTH)
        lo[same] = LENGTH
        k = np.flatnonzero(~same)
        a, b, low, high = i[k], j[k], np.zeros(len(k), dtype=np.int64), np.full(len(k), LENGTH - 1)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            ok = self.powers.hashes(self.prefix, a, mid) == self.powers.hashes(self.prefix, b, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        lo[k] = low
        return lo

    def before(self, i: np.ndarray, j: np.ndarray, or_equal: bool) -> np.ndarray:
        """Does suffix i come before suffix j?"""
        e = self.extension(i, j)
        tie = e >= LENGTH
        e = np.minimum(e, LENGTH - 1)
        return np.where(tie, or_equal, self.buf[i + e] < self.buf[j + e])

    def rank(self, own: np.ndarray, start: np.ndarray, end: np.ndarray, s: np.ndarray, after_equal: bool) -> np.ndarray:
        """How many of s[start:end] (sorted) come before each of ``own``."""
        lo, hi = start.copy(), end.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            first = self.before(s[mid], own[todo], after_equal)
            lo[todo], hi[todo] = np.where(first, mid + 1, lo[todo]), np.where(first, hi[todo], mid)
            todo = todo[lo[todo] < hi[todo]]
        return lo - start

    def sort(self, s: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """s: suffixes, those of one class side by side. The order within each class."""
        at = np.arange(len(s))
        head = np.concatenate([[0], np.flatnonzero(classes[1:] != classes[:-1]) + 1]) if len(s) else at
        length = np.diff(np.append(head, len(s)))
        begin, stop = np.repeat(head, length), np.repeat(head + length, length)
        width = 1
        while len(s) and width < length.max():
            block = (at - begin) // width
            mate = np.where(block % 2 == 0, block + 1, block - 1)
            lo = np.minimum(begin + mate * width, stop)
            hi = np.minimum(lo + width, stop)
            ahead = np.empty(len(s), dtype=np.int64)
            for odd in (0, 1):  # equal suffixes of the left half stay first
                k = np.flatnonzero(block % 2 == odd)
                ahead[k] = self.rank(s[k], lo[k], hi[k], s, bool(odd))
            to = begin + (block - block % 2) * width + (at - begin - block * width) + ahead
            moved = np.empty_like(s)
            moved[to] = s
            s, width = moved, width * 2
        return s

    def ties(self, s: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Marks of the sorted suffixes that agree with a neighbour of their class in LENGTH bytes."""
        k = np.flatnonzero(classes[1:] == classes[:-1])
        k = k[self.extension(s[k], s[k + 1]) >= LENGTH]
        mark, step = np.zeros(len(s), dtype=bool), np.arange(LENGTH)
        for a in range(0, len(k), 4096):
            part = k[a:a + 4096]
            part = part[(self.buf[s[part][:, None] + step] == self.buf[s[part + 1][:, None] + step]).all(axis=1)]
            mark[part] = mark[part + 1] = True
        return mark


def repeated_windows(groups: list, powers: Powers) -> list[np.ndarray]:
    """groups: (group, off, bytes) of contexts. For each, which of its windows repeat in its group."""
    buf = np.frombuffer(b"".join(g[2] for g in groups), dtype=np.uint8)
    size = np.array([len(g[2]) for g in groups])
    base, windows = np.cumsum(size) - size, size - LENGTH + 1
    owner = np.repeat(np.arange(len(groups)), windows)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    # equal windows have their anchor at equal places, so only such suffixes are compared
    classes = np.array([g[0] for g in groups])[owner] * (1 << 9) + np.array([g[1] for g in groups])[owner] - window + LENGTH
    s = base[owner] + window
    order = np.argsort(classes, kind="stable")
    kinds, counts = np.unique(classes, return_counts=True)
    order = order[counts[np.searchsorted(kinds, classes[order])] > 1]
    sorter = SuffixSorter(buf, powers)
    sorted_s, sorted_classes = sorter.sort(s[order], classes[order]), classes[order]
    hit = np.zeros(len(buf), dtype=bool)
    hit[sorted_s[sorter.ties(sorted_s, sorted_classes)]] = True
    return [hit[b:b + n] for b, n in zip(base, windows)]


def spans_of(marks: np.ndarray) -> list[tuple[int, int]]:
    """Runs of marks: (first, number)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()))


def sorted_contexts(contexts: DataFrame) -> DataFrame:
    """contexts: anchor, k1, s, off, single, bytes. k1, s, windows of what repeats in runs that occur once."""
    def flush(groups, ids, out, powers):
        for (k1, s, single), marks in zip(ids, repeated_windows(groups, powers)):
            if single:
                out += [(k1, s + a, n) for a, n in spans_of(marks)]

    def run(batches):
        powers, groups, ids, size, number, last = Powers(), [], [], 0, 0, None
        for b in batches:
            out = []
            for anchor, k1, s, off, single, data in zip(*(c.to_pylist() for c in b.columns)):
                if anchor != last:
                    if size > BUFFER:  # whole groups only
                        flush(groups, ids, out, powers)
                        groups, ids, size = [], [], 0
                    number, last = number + 1, anchor
                groups.append((number, off, data))
                ids.append((k1, s, single))
                size += len(data)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["k1", "s", "n"])
        out = []
        if groups:
            flush(groups, ids, out, powers)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["k1", "s", "n"])

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "k1 long, s long, n long")


def counted_windows(contexts: DataFrame) -> DataFrame:
    """The same result for anchors of very many runs: a row and a 128-bit hash for each window."""
    def run(batches):
        import xxhash

        for b in batches:
            for anchor, k1, s, off, single, data in zip(*(c.to_pylist() for c in b.columns)):
                d = [xxhash.xxh3_128_intdigest(data[i:i + LENGTH]) for i in range(len(data) - LENGTH + 1)]
                n = len(d)
                yield pa.RecordBatch.from_arrays([
                    pa.array([(x >> 64) - (1 << 63) for x in d], pa.int64()), pa.array([(x & ((1 << 64) - 1)) - (1 << 63) for x in d], pa.int64()),
                    pa.array([k1] * n, pa.int64()), pa.array(range(s, s + n), pa.int64()), pa.array([single] * n, pa.bool_())],
                    names=["h1", "h2", "k1", "s", "single"])

    rows = contexts.mapInArrow(run, "h1 long, h2 long, k1 long, s long, single boolean")
    often = rows.groupBy("h1", "h2").agg(F.count("*").alias("c")).filter("c > 1").select("h1", "h2")
    return rows.filter("single").join(often, ["h1", "h2"]).select("k1", "s", F.lit(1).cast("long").alias("n"))


def contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """anchor, k1, s, off, single, bytes of the runs asked for. asked: k1, anchor, place, single."""
    asked = cut_lineage(asked.groupBy("k1").agg(F.collect_list(F.struct("anchor", "place", "single")).alias("asked")))
    texts = maybe_in(docs, "k1", id_filter(asked, "k1")).dropDuplicates(["k1"])  # copies of a row have the same bytes

    def run(batches):
        for b in batches:
            for k1, text, runs in zip(b.column(0).to_pylist(), text_bytes(b), b.column(2)):
                runs = runs.values
                anchor, at, single = (runs.field(i) for i in range(3))
                s, _, n, off = place_parts(at.to_numpy())
                data = [text[i:i + m + LENGTH - 1] for i, m in zip(s.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([anchor, pa.array([k1] * len(data), pa.int64()), pa.array(s), pa.array(off), single, pa.array(data, pa.binary())],
                                                 names=["anchor", "k1", "s", "off", "single", "bytes"])

    return texts.join(asked, "k1").mapInArrow(run, "anchor long, k1 long, s long, off long, single boolean, bytes binary")


def repeats(docs: DataFrame, wide: int = 20_000) -> DataFrame:
    """k1, s, n: n windows from byte s on repeat. docs: k1, text."""
    often = cut_lineage(run_rows(docs, False).groupBy("anchor").agg(F.sum("c").alias("c")).filter("c > 1").select("anchor"))
    runs = cut_lineage(run_rows(docs, True).join(often, "anchor"))
    kinds = cut_lineage(runs.groupBy("anchor", "seg").agg(F.sum("c").alias("c"), F.min(F.struct("k1", "place")).alias("one")))
    s, reps, n, _ = place_columns("place")
    whole = runs.join(kinds.filter("c > 1").select("anchor", "seg"), ["anchor", "seg"]).select("k1", s.alias("s"), (reps * n).alias("n"))
    mixed = cut_lineage(kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("c").alias("least")).filter("kinds > 1 and least = 1"))
    one = kinds.select("anchor", "one.k1", "one.place", (F.col("c") == 1).alias("single"))
    found = whole.unionByName(sorted_contexts(contexts(docs, one.join(mixed.filter(F.col("kinds") <= wide), "anchor"))))
    many = mixed.filter(F.col("kinds") > wide)
    if many.limit(1).count():
        found = found.unionByName(counted_windows(contexts(docs, one.join(many, "anchor"))))
    return found


def dedup(docs: DataFrame, wide: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay) for every row of docs."""
    text = F.coalesce("text", F.lit(""))
    keyed = small_batches(docs).select("doc_id", F.xxhash64(text).alias("k1"), "text")
    # copies agree in 64 more bits and in length: a whole text goes on no less
    again = F.struct(F.xxhash64(F.lit("again"), text).alias("h"), F.octet_length(text).alias("n"))
    copies = (small_batches(docs).select(F.xxhash64(text).alias("k1"), again.alias("v")).groupBy("k1").agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
              .filter("c > 1 and lo = hi").select("k1", F.lit(0).cast("long").alias("s"), F.lit(-1).cast("long").alias("n")))
    found = cut_lineage(repeats(keyed.select("k1", "text"), wide).unionByName(copies).groupBy("k1").agg(F.collect_set(F.struct("s", "n")).alias("found")))
    bits = id_filter(found, "k1")

    def run(batches):
        for b in batches:
            out = [[], [], [], [], []]
            for text, found in zip(text_bytes(b), b.column(2)):
                spans = []
                s, n = (found.values.field(i).to_numpy() for i in range(2)) if found.is_valid else (np.zeros(0, dtype=np.int64),) * 2
                if len(n) and n.min() < 0:
                    spans = [(0, len(text))] if len(text) >= LENGTH else []
                elif len(n):
                    gone = np.zeros(len(text) + 1, dtype=np.int32)
                    np.add.at(gone, s, 1)
                    np.add.at(gone, s + n + LENGTH - 1, -1)
                    spans = spans_of(np.cumsum(gone[:-1]) > 0)
                at, kept = 0, []
                for a, m in spans:
                    kept.append(text[at:a])
                    at = a + m
                kept = b"".join(kept) + text[at:]
                for col, v in zip(out, (len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, t) for x, t in zip(out, types))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    touched = maybe_in(keyed, "k1", bits).join(found, "k1", "left").select("doc_id", "text", "found")
    rest = maybe_in(keyed, "k1", bits, False).select("doc_id", "text", F.expr("cast(null as array<struct<s: bigint, n: bigint>>)").alias("found"))
    return touched.unionByName(rest).mapInArrow(run, schema)
