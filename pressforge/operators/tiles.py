"""Rectangle overlap join on a grid, for images with any number of boxes.

A join on the image alone meets every word of an image with every box of it. Here both are
dealt to the tiles that they touch and joined on (image, tile), so a word meets only boxes
near it, and an image with very many of them is spread over its tiles. A pair that shares
several tiles is judged in one of them, that of the upper left corner of the overlap, so
pairs need no distinct step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geometry import iou

TILE = 64


def _tiles(lo: Column, hi: Column, size: int) -> Column:
    """Numbers of the tiles that [lo, hi) touches; none if it is empty."""
    first, last = F.floor(lo / size), F.floor((hi - 1) / size)
    return F.when(hi > lo, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<bigint>"))


def tiled(df: DataFrame, box: list[str], size: int = TILE) -> DataFrame:
    """The rows of ``df`` once for every tile (tx, ty) of their box."""
    x1, y1, x2, y2 = (F.col(c) for c in box)
    d = df.withColumn("tx", F.explode(_tiles(x1, x2, size)))
    return d.withColumn("ty", F.explode(_tiles(y1, y2, size)))


def overlapping(a: DataFrame, b: DataFrame, key: str, a_box: list[str], b_box: list[str], min_iou: float, size: int = TILE) -> DataFrame:
    """Pairs of a row of ``a`` and a row of ``b`` with the same key whose boxes' intersection over
    union is above ``min_iou`` (0 or more), each pair once. Column names are distinct but for the key."""
    j = tiled(a, a_box, size).join(tiled(b, b_box, size), [key, "tx", "ty"])
    ax1, ay1, bx1, by1 = (F.col(c) for c in (a_box[0], a_box[1], b_box[0], b_box[1]))
    here = (F.floor(F.greatest(ax1, bx1) / size) == F.col("tx")) & (F.floor(F.greatest(ay1, by1) / size) == F.col("ty"))
    return j.filter(here & (iou([F.col(c) for c in a_box], [F.col(c) for c in b_box]) > F.lit(min_iou))).drop("tx", "ty")
