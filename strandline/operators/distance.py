"""Distances to marked pixels by an exact, separable transform on tiles with a halo.

First the gap to the nearest mark in each pixel's own column, by running maxima; then, along the rows, the least sum of
squares. A mark goes to its own tile and to those within reach of it: tiles are at least four times as wide as the
reach, so that is 2.25 tiles on average at most, whatever the reach. A task holds one tile.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

#: Pixels on a tile's side, at least.
TILE = 256
#: A gap beyond any tile.
FAR = 1 << 28


def tile_for(reach: int) -> int:
    return max(TILE, 4 * reach)


def in_tiles(pixels: DataFrame, tile: int, halo: int) -> DataFrame:
    """Each row once in each tile (_tr, _tc) within ``halo`` of it."""
    span = lambda v: F.sequence(F.floor((F.col(v) - halo) / tile), F.floor((F.col(v) + halo) / tile))
    return pixels.withColumn("_tr", F.explode(span("row"))).withColumn("_tc", F.explode(span("col")))


def column_gaps(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to the nearest mark at or above each pixel and at or below it, in its own column; FAR where there is none."""
    n = len(marked)
    row = np.arange(n, dtype=np.int32)[:, None]
    above = np.maximum.accumulate(np.where(marked, row, -FAR), axis=0)
    below = np.minimum.accumulate(np.where(marked, row, FAR)[::-1], axis=0)[::-1]
    return np.minimum(row - above, FAR), np.minimum(below - row, FAR)


def within(gap: np.ndarray, reach: int) -> np.ndarray:
    """Pixels whose distance to a mark is at most ``reach``; ``gap`` is each pixel's to its own column's marks, and the
    result loses ``reach`` columns at each side. A column's mark covers an interval of the row: their union."""
    rows, cols = np.nonzero(gap <= reach)
    half = np.array([math.isqrt(reach * reach - g * g) for g in range(reach + 1)])[gap[rows, cols]]
    wide = gap.shape[1]
    edge = np.zeros((len(gap), wide + 1), np.int32)
    np.add.at(edge, (rows, np.maximum(cols - half, 0)), 1)
    np.add.at(edge, (rows, np.minimum(cols + half + 1, wide)), -1)
    return (edge[:, :wide].cumsum(1) > 0)[:, reach : wide - reach]


def squares(gap: np.ndarray, reach: int) -> np.ndarray:
    """Squared distance to the nearest mark, exact up to ``reach``; loses ``reach`` columns at each side as within()."""
    tall = np.minimum(gap, FAR >> 14).astype(np.int64) ** 2
    inner = gap.shape[1] - 2 * reach
    out = tall[:, reach : reach + inner].copy()
    for d in range(1, reach + 1):
        np.minimum(out, tall[:, reach - d : reach - d + inner] + d * d, out=out)
        np.minimum(out, tall[:, reach + d : reach + d + inner] + d * d, out=out)
    return out


def _window(table: pa.Table, top: int, left: int, size: int) -> np.ndarray:
    """The marks of ``table`` as a square bitmap whose first pixel is (top, left)."""
    marked = np.zeros((size, size), bool)
    marked[table.column("row").to_numpy() - top, table.column("col").to_numpy() - left] = True
    return marked


def _by_tile(marks: DataFrame, reach: int, by: list[str], found, more: list[StructField]) -> DataFrame:
    """``found(gap)`` [tile, tile] and further arrays of its true pixels, as rows (by, row, col, ..)."""
    tile = tile_for(reach)
    schema = StructType([marks.schema[c] for c in (*by, "row", "col")] + more)
    kinds = {c: marks.schema[c].dataType.simpleString() for c in ("row", "col")}

    def task(key: tuple, table: pa.Table) -> pa.Table:
        top, left = int(key[-2].as_py()) * tile, int(key[-1].as_py()) * tile
        marked = _window(table, top - reach, left - reach, tile + 2 * reach)
        gap = np.minimum(*column_gaps(marked))[reach : reach + tile]
        inside, *extra = found(gap)
        r, c = np.nonzero(inside)
        same = [pa.repeat(k, len(r)) for k in key[:-2]]
        at = [pa.array(v).cast(pa.int32() if kinds[n] == "int" else pa.int64()) for n, v in (("row", r + top), ("col", c + left))]
        return pa.table([*same, *at, *[pa.array(x[r, c]) for x in extra]], names=schema.names)

    return in_tiles(marks.select(*by, "row", "col"), tile, reach).groupBy(*by, "_tr", "_tc").applyInArrow(task, schema)


def dilated(marks: DataFrame, radius: int, by: list[str]) -> DataFrame:
    """Pixels (by, row, col) within ``radius`` of a marked pixel (by, row, col), each once. Marks may repeat."""
    return _by_tile(marks, radius, by, lambda gap: (within(gap, radius),), [])


def distances(marks: DataFrame, reach: int, by: list[str] = ("scene_id",)) -> DataFrame:
    """(by, row, col, square): the squared distance, in pixels, to the nearest marked pixel, up to ``reach``."""

    def found(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = squares(gap, reach)
        return s <= reach * reach, s

    return _by_tile(marks, reach, list(by), found, [StructField("square", LongType())])


def nearer(rows: np.ndarray, cols: np.ndarray, marked: np.ndarray, top: int, left: int, tall: np.ndarray, wide: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether a mark lies nearer than ``least`` to each point (rows, cols: pixels in halves); ``tall`` and ``wide`` are
    the height and width of a pixel. The bitmap ``marked`` begins at (top, left) and holds all marks in reach."""
    above, below = column_gaps(marked)
    high, low = np.floor(rows).astype(int) - top, np.ceil(rows).astype(int) - top
    part_high, part_low = rows - np.floor(rows), np.ceil(rows) - rows
    out = np.zeros(len(rows), bool)
    if not len(rows):
        return out
    middle = np.floor(cols).astype(int)
    most = int(np.ceil(np.max(least / wide))) + 1
    for d in range(-most, most + 2):
        c = middle + d - left
        inside = (c >= 0) & (c < marked.shape[1])
        c = np.where(inside, c, 0)
        gap = np.minimum(above[high, c] + part_high, below[low, c] + part_low)
        square = (gap * tall) ** 2 + ((middle + d - cols) * wide) ** 2
        out |= inside & (gap < FAR / 2) & (square < least**2)
    return out


def away_from_pixels(points: DataFrame, mask: DataFrame, reach: int, tile: int | None = None) -> DataFrame:
    """Points with no pixel of ``mask`` nearer than their distance to it, in the same scene.

    points (scene_id, row, col: doubles in halves of a pixel, tall, wide: a pixel's height and width, .., and
    ``least_<name>``: the distance) and mask (scene_id, row, col, and a boolean for each ``<name>``). ``reach`` is a
    number of pixels that no distance exceeds. Points and marks meet by tile.
    """
    flags = [c[6:] for c in points.columns if c.startswith("least_")]
    tile = tile or tile_for(reach + 2)
    own = points.withColumn("_tr", F.floor(F.col("row") / tile)).withColumn("_tc", F.floor(F.col("col") / tile))
    marks = in_tiles(mask.select("scene_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), *flags), tile, reach + 2)
    schema = StructType([*points.schema, StructField("_near", BooleanType())])
    names = points.columns

    def task(key: tuple, here: pa.Table, there: pa.Table) -> pa.Table:
        near = np.zeros(here.num_rows, bool)
        if here.num_rows and there.num_rows:
            top, left = int(key[1].as_py()) * tile - reach - 2, int(key[2].as_py()) * tile - reach - 2
            value = {c: here.column(c).to_numpy() for c in ("row", "col", "tall", "wide", *[f"least_{f}" for f in flags])}
            for f in flags:
                marked = _window(there.filter(there.column(f)), top, left, tile + 2 * (reach + 2))
                near |= nearer(value["row"], value["col"], marked, top, left, value["tall"], value["wide"], value[f"least_{f}"])
        return here.select(names).append_column("_near", pa.array(near))

    keys = ("scene_id", "_tr", "_tc")
    out = own.groupBy(*keys).cogroup(marks.groupBy(*keys)).applyInArrow(task, schema)
    return out.where("not _near").drop("_near")
