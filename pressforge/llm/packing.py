"""Best-fit-decreasing packing of token sequences.

Texts are tokenised and end with id 0; only documents longer than ``capacity``
are cut, into pieces of ``capacity`` tokens. Pieces are packed longest first,
each into the tightest open sequence that holds it.

Pieces of one length are interchangeable, so the packing itself needs only how
many pieces each length has: at most ``capacity`` numbers, whatever the size of
the corpus. Open sequences are kept as runs of equal remaining capacity, and a
segment tree over remaining capacities finds the tightest one that fits in
logarithmic time. The result is a list of steps, "pieces a.. of length s go to
sequences b.. at offset o", whose number is bounded by ``capacity`` too. Spark
numbers the pieces of each length (block counts first, so no length is ever
numbered in one task) and joins them to the steps.

Edge cases: a null or empty text is one piece holding only id 0. Repeated rows
are packed once for each row. No rows give no rows. Columns other than doc_id
and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressforge.session import cut_lineage

from .common import small_batches

CAPACITY = 2048
BLOCKS = 1024
TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_letters() -> dict[int, str]:
    """Byte -> the character a byte-level tokeniser writes for it: printable Latin-1 stands for
    itself, the rest follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def word_wise(tok) -> bool:
    """Does a tokeniser lower-case, drop white space, and mark word ends? Then words can be encoded one by one."""
    import json

    made = json.loads(tok.to_str())

    def kinds(part) -> set:
        return {part["type"], *(k for x in [*part.get("normalizers", []), *part.get("pretokenizers", [])] for k in kinds(x))} if part else set()

    return made["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in kinds(made.get("normalizer")) and {"Split", "ByteLevel"} <= kinds(made.get("pre_tokenizer"))


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    The tokeniser never joins characters over white space, so each
    blank-separated word is encoded once and remembered (a bounded number of
    words). It lower-cases what it reads, so words differing in A-Z are one.
    A word of Latin letters, with or without marks after it, goes straight to the
    vocabulary's merges: its letters and its marks are one piece each for the
    tokeniser, and its normalisation leaves them as they are. A text that may hold
    a special token's name goes to the tokeniser whole.

    Only for tokenisers that are so made (see ``word_wise``); others read whole texts.
    """

    LIMIT = 700_000
    SIMPLE = "([a-zß-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)"

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.tok, self.known, self.parts = Tokenizer.from_file(path), {}, {}
        self.word_wise = word_wise(self.tok)
        self.letters, self.simple = str.maketrans({chr(b): c for b, c in byte_letters().items()}), re.compile(self.SIMPLE).fullmatch

    def encode(self, texts: list[str]) -> list[bytes]:
        many = self.tok.encode_batch(texts, add_special_tokens=False)
        return [b"".join(i.to_bytes(4, "little") for i in e.ids) for e in many]

    def part(self, s: str) -> bytes:
        ids = self.parts.get(s)
        if ids is None:
            tokens = self.tok.model.tokenize(s.encode().decode("latin-1").translate(self.letters))
            ids = self.parts[s] = b"".join(t.id.to_bytes(4, "little") for t in tokens)
        return ids

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if not self.word_wise:
            return self.encode([t.decode() for t in texts])
        known, other = self.known, []
        if len(known) > self.LIMIT:
            known.clear()
            self.parts.clear()
        words = [None if b"<|" in t else t.lower().split() for t in texts]
        for w in {w for ws in words if ws is not None for w in ws if w not in known}:
            m = self.simple(w.decode().lower())
            if m:
                known[w] = self.part(m[1]) + (self.part(m[2]) if m[2] else b"")
            else:
                other.append(w)
        known.update(zip(other, self.encode([w.decode() for w in other])))
        return [self.encode([t.decode()])[0] if ws is None else b"".join(map(known.__getitem__, ws))
                for t, ws in zip(texts, words)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece. ``tokenizer`` is a file name looked up on the worker."""
    def run(batches):
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc, end = Encoder(public_tokenizers.path(tokenizer)), b"\0\0\0\0"
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = [[], [], [], [], []]
                texts = [x or b"" for x in part.column(1).cast(pa.binary()).to_pylist()]
                for d, ids in zip(part.column(0).to_pylist(), enc.ids(texts)):
                    ids = memoryview(ids + end)
                    for k in range(0, len(ids) // 4, capacity):
                        one = ids[4 * k:4 * (k + capacity)]
                        for col, v in zip(out, (d, k // capacity, k, len(one) // 4, zlib.crc32(one))):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


class TightestFit:
    """Segment tree over remaining capacities: which have an open sequence."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, r: int, on: bool) -> None:
        i = r + self.size
        self.any[i] = on
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def find(self, s: int) -> int | None:
        """The smallest remaining capacity >= s that has an open sequence."""
        i = s + self.size
        if self.any[i]:
            return s
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """counts: pieces of each length. Steps (length, first, n, per, sequence, offset): of the
    pieces of that length, number first + i for i < n goes to sequence + i // per,
    at offset + i % per * length."""
    tree, open_runs, steps, opened = TightestFit(capacity), [deque() for _ in range(capacity + 1)], [], 0

    def leave(r: int, b: int, n: int) -> None:
        if n and r:
            open_runs[r].append((b, n))
            tree.set(r, True)

    for s in sorted(counts, reverse=True):
        first, left = 0, counts[s]
        while left:
            r = tree.find(s)
            if r is None:
                r, b, n = capacity, opened, -(-left // (capacity // s))
                opened += n
            else:
                b, n = open_runs[r].popleft()
                if not open_runs[r]:
                    tree.set(r, False)
            # the tightest sequence stays the tightest until no further piece of this length fits
            per = r // s
            full = min(n, left // per)
            rest = min(left - full * per, per - 1) if full < n else 0
            for at, bins, k in ((b, full, per), (b + full, int(rest > 0), rest)):
                if bins:
                    steps.append((s, first, bins * k, k, at, capacity - r))
                    first, left = first + bins * k, left - bins * k
                    leave(r - k * s, at, bins)
            leave(r, b + full + (rest > 0), n - full - (rest > 0))
    return steps


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = small_batches(docs).sparkSession
    cut = cut_lineage(pieces(docs, capacity, tokenizer))
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    steps = spark.createDataFrame(best_fit_decreasing(counts, capacity),
                                  "length long, first long, n long, per long, sequence long, base long")
    block = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BLOCKS))
    rows = cut.withColumn("block", block)
    before = (rows.groupBy("length", "block").agg(F.count("*").alias("n"))
              .select("length", "block", (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before")))
    own = F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32"))
    rank = rows.withColumn("own", own).join(before, ["length", "block"]).withColumn("rank", F.col("before") + F.col("own") - 1)
    # steps are bounded by the capacity, not by the corpus
    p, s = rank.alias("p"), F.broadcast(steps).alias("s")
    i = F.col("rank") - F.col("first")
    return (p.join(s, (F.col("p.length") == F.col("s.length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))
            .select("doc_id", "piece", "start", F.col("p.length").alias("length"), "ids_crc32",
                    (F.col("sequence") + F.floor(i / F.col("per"))).alias("sequence_id"),
                    (F.col("base") + i % F.col("per") * F.col("p.length")).alias("offset")))
