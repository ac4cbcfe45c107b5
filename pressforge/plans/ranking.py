"""Exact ordered ranks and running sums without a single-partition window.

``row_number() over (partition by p order by k)`` puts a whole partition key in
one task: a hot key (one bucket holding a third of the rows) or an empty
``partition by`` (a global order) does not scale. For a unique integer order
key we split the key range into blocks of ``2^bits`` consecutive values:

* per (p, block) counts / sums - a partial aggregation, small output;
* block offsets - a running sum over that table, level by level (groups of
  65,536 blocks, groups of groups, ...), so sparse keys are bounded too;
* the in-block rank - a window over (p, block), at most ``2^bits`` rows each.

The result is exact and every task sees a bounded amount of data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MAX_BLOCKS = 1 << 20
# Block width for dense integer keys (arrival numbers, row ids): 65,536 keys
# per block. Exact for any key; only the block sizes depend on density.
DENSE_BITS = 16


def auto_bits(df: DataFrame, order_col: str, max_blocks: int = MAX_BLOCKS) -> int:
    """Block width so the key range splits into at most ``max_blocks`` blocks
    (one scalar min/max aggregate)."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        return 0
    span = int(hi) - int(lo) + 1
    bits = 0
    while (span >> bits) > max_blocks:
        bits += 1
    return bits


def _block(order_col: str, bits: int):
    return F.shiftright(F.col(order_col).cast("bigint"), bits)


FAN_BITS = 16


def block_offsets(stats: DataFrame, part: list[str], val: str, bits: int, fan_bits: int | None = None) -> DataFrame:
    """Exclusive running sum of ``val`` over blocks, per partition key, level by level: blocks in
    groups of 2^fan_bits, groups in groups, until 63 bits of key are used up. A window sees the
    2^fan_bits members of one group at most, also when keys are sparse and every row is a block
    of its own; with dense keys the upper levels hold a row or two."""
    fan_bits = FAN_BITS if fan_bits is None else fan_bits
    levels = max(2, -(-(64 - bits) // fan_bits))
    up = [f"_u{i}" for i in range(levels)]
    s = stats.withColumns({u: F.shiftright(F.col("_blk"), min(63, fan_bits * i)) for i, u in enumerate(up)})
    total = None
    for i in range(levels):  # level i: the sum before block _ui inside its group _u(i+1)
        group = [*part, *up[i + 1:i + 2]]
        at = s.groupBy(*part, *up[i:i + 2]).agg(F.sum(val).alias("_v"))
        w = Window.partitionBy(*group).orderBy(up[i]).rowsBetween(Window.unboundedPreceding, -1)
        at = at.select(*part, up[i], F.coalesce(F.sum("_v").over(w), F.lit(0)).alias(f"_o{i}"))
        total = s.select(*part, *up, "_blk").join(at, [*part, up[i]]) if total is None else total.join(at, [*part, up[i]])
    return total.select(*part, "_blk", sum((F.col(f"_o{i}") for i in range(1, levels)), F.col("_o0")).alias("_off"))


def sorted_keys(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Adds a unique integer key that grows in the order of any columns: a sort by ranges, then row
    numbers of the sorted partitions (sparse, which the block-split sums allow). The result is
    written to the checkpoint folder, so that the numbers stay as they are."""
    return cut_lineage(df.orderBy(*order).withColumn(out, F.monotonically_increasing_id()))


def ordered_rank(df: DataFrame, order_col: str, part_cols: list[str] | None = None,
                 out: str = "rn", bits: int | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Exact ``row_number()`` over (partition by part_cols order by
    order_col, *tiebreak).

    ``order_col`` is an integer key (blocks are cut on it); ``(order_col,
    *tiebreak)`` must be unique within each partition key. Ties on the
    integer key stay inside one block and are ordered by ``tiebreak``, so no
    packing of several keys into one integer is needed.
    """
    part = list(part_cols or [])
    ties = list(tiebreak or [])
    bits = auto_bits(df, order_col) if bits is None else bits
    d = df.withColumn("_blk", _block(order_col, bits))
    stats = d.groupBy(*part, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    offs = block_offsets(stats, part, "_n", bits)
    local = F.row_number().over(Window.partitionBy(*part, "_blk").orderBy(order_col, *ties))
    d = d.withColumn("_loc", local)
    return (d.join(offs, part + ["_blk"])
            .withColumn(out, (F.col("_off") + F.col("_loc")).cast("bigint"))
            .drop("_blk", "_loc", "_off"))


def ordered_running_sum(df: DataFrame, value_col: str, order_col: str, part_cols: list[str] | None = None,
                        out: str = "running", bits: int | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Exact ``sum(v) over (partition by p order by k, *tiebreak rows unbounded preceding)``."""
    part = list(part_cols or [])
    bits = auto_bits(df, order_col) if bits is None else bits
    d = df.withColumn("_blk", _block(order_col, bits))
    stats = d.groupBy(*part, "_blk").agg(F.sum(value_col).alias("_s"))
    offs = block_offsets(stats, part, "_s", bits)
    wl = Window.partitionBy(*part, "_blk").orderBy(order_col, *(tiebreak or [])).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_loc", F.sum(value_col).over(wl))
    return d.join(offs, part + ["_blk"]).withColumn(out, F.col("_off") + F.col("_loc")).drop("_blk", "_loc", "_off")
