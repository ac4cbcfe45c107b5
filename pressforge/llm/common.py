"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """crc32 of an id's text, modulo n (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(n))


BATCH_ROWS = 1000


def small_batches(docs: DataFrame) -> DataFrame:
    """Texts can be long, so Python tasks get at most BATCH_ROWS of them at a time (a setting of the
    session; a smaller one stays)."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return docs


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable."""
    return F.transform(F.array(value), body)[0]


def mix64(x):
    """A finaliser for numpy uint64 hashes: every input bit reaches the high bits."""
    import numpy as np

    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Word bytes -> 64-bit hash, remembered for a bounded number of words."""

    LIMIT = 200_000

    def __missing__(self, word):
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = h
        return h

    def of(self, words):
        import numpy as np

        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def as_long(h):
    """numpy uint64 -> the same bits as int64 (Spark's long)."""
    import numpy as np

    return h.view(np.int64)


def text_bytes(batch, name: str = "text") -> list:
    """A string column of an Arrow batch as UTF-8 bytes; null is empty."""
    import pyarrow as pa

    col = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [b"" if x is None else x for x in col.to_pylist()]


WS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; a text of ASCII alone takes the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(docs: DataFrame) -> DataFrame:
    """Adds k1, k2: a 128-bit key of (doc_id, text), so that null ids and repeated ids join
    only with themselves."""
    return docs.withColumns({"k1": F.xxhash64(F.col("doc_id"), F.col("text")),
                             "k2": F.xxhash64(F.lit("key"), F.col("text"), F.col("doc_id"), F.col("text").isNull())})


FILTER_BITS = 24


def id_filter(ids: DataFrame, column: str):
    """A broadcast bitmap of 2^FILTER_BITS places (2 MB, whatever the number of ids): may an id be
    among ``ids``? It only saves moving rows that a later join would drop."""
    import numpy as np

    place = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS)) + 1
    rows = (ids.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())  # 512 rows of 4 kB at most
    bits = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r.bits), dtype=np.uint8)
        bits[(r.k - 1) * 4096:(r.k - 1) * 4096 + len(part)] = part
    return ids.sparkSession.sparkContext.broadcast(bits)


def maybe_in(docs: DataFrame, column: str, bits, inside: bool = True) -> DataFrame:
    """The rows of docs whose ``column`` may be in the filter (or, if not ``inside``, surely isn't)."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            p = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            on = (bits.value[p >> 3] >> (p & 7)) & 1
            yield b.drop_columns(["p__"]).filter(pa.array((on == 1) == inside))

    place = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
    return docs.withColumn("p__", place).mapInArrow(run, docs.schema)
