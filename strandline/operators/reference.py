"""Buffers about reference lines in each scene's own grid: lines brought to the scenes' zones, cut to tiles, rasterised there.

Lines come as longitude and latitude. Each segment is projected to the UTM zones in which a scene may hold it; it meets
the tiles of those scenes by cells of the plane, and a task draws the segments of one tile. No scene is held whole and
no line is sent to all scenes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.operators.distance import TILE
from strandline.operators.distance import dilated as disks

#: Side of the cells, in metres, in which segments and tiles meet.
CELL = 1024.0


def tiles_of(pixels: DataFrame, tile: int = TILE) -> DataFrame:
    """scene_id, _tr, _tc of the tiles that have pixels (scene_id, row, col)."""
    return pixels.select("scene_id", F.floor(F.col("row") / tile).alias("_tr"), F.floor(F.col("col") / tile).alias("_tc")).distinct()


def in_zones(vertices: DataFrame) -> DataFrame:
    """vertices (lon, lat, ..) with epsg, x, y: once for the zone of each, and for those beside it, north and south."""
    own = F.floor((F.col("lon") + 180) / 6).cast("int")
    near = F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.pmod(own + d, F.lit(60)) + 1)
    codes = F.concat(F.transform(near, lambda z: z + 32600), F.transform(near, lambda z: z + 32700))
    v = vertices.withColumn("epsg", F.explode(codes)).where(((F.col("epsg") < 32700) & (F.col("lat") > -2)) | ((F.col("epsg") > 32700) & (F.col("lat") < 2)))
    return geo.with_utm(v, "lon", "lat", "epsg")


def segments_in_zones(lines: DataFrame) -> DataFrame:
    """epsg, x0, y0, x1, y1 of the segments of lines (line_id, seq, lon, lat), in every zone where both ends are."""
    placed = lines.select("line_id", "lon", "lat", F.row_number().over(Window.partitionBy("line_id").orderBy("seq")).alias("_k"))
    after = Window.partitionBy("line_id", "epsg").orderBy("_k")
    v = in_zones(placed).select("epsg", "x", "y", "_k", F.lead(F.struct("_k", "x", "y")).over(after).alias("_v"))
    return v.where("_v._k = _k + 1").select("epsg", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("_v.x").alias("x1"), F.col("_v.y").alias("y1"))


def _tile_boxes(tiles: DataFrame, grids: DataFrame, tile: int) -> DataFrame:
    """Tiles with their scene's georeference g, epsg and the box of the tile in the world (_minx, ..)."""
    t = tiles.join(grids.select("scene_id", F.col("georef").alias("g"), "epsg"), "scene_id")
    corners = [geo.pixel_to_world((F.col("_tr") + i) * tile, (F.col("_tc") + j) * tile, [F.col("g")[k] for k in range(6)]) for i in (0, 1) for j in (0, 1)]
    of = lambda fn, k: fn(*[c[k] for c in corners])
    return t.withColumns({"_minx": of(F.least, 0), "_miny": of(F.least, 1), "_maxx": of(F.greatest, 0), "_maxy": of(F.greatest, 1)})


def line_buffer(lines: DataFrame, grids: DataFrame, tiles: DataFrame, max_dist: float = 100, tile: int = TILE) -> DataFrame:
    """scene_id, row, col of the pixels of the tiles whose centre is within ``max_dist`` metres of a line.

    lines (line_id, seq, lon, lat), grids (scene_id, georef, epsg), tiles as of tiles_of(). Distances are measured in
    each scene's own zone. A line of one vertex, and null ends, draw nothing.
    """
    span = lambda a, b: F.explode(F.sequence(F.floor(a / CELL), F.floor(b / CELL)))
    length = geo.distance("x0", "y0", "x1", "y1")
    s = segments_in_zones(lines).withColumn("_n", F.greatest(F.ceil(length / CELL), F.lit(1))).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / F.col("_n")
    piece = {c: [at(f"{c}0", f"{c}1", F.col("_k") + i) for i in (0, 1)] for c in "xy"}
    s = s.withColumn("_cx", span(F.least(*piece["x"]) - max_dist, F.greatest(*piece["x"]) + max_dist))
    s = s.withColumn("_cy", span(F.least(*piece["y"]) - max_dist, F.greatest(*piece["y"]) + max_dist)).select("epsg", "_cx", "_cy", "x0", "y0", "x1", "y1").distinct()
    t = _tile_boxes(tiles, grids, tile)
    t = t.withColumn("_cx", span(F.col("_minx"), F.col("_maxx"))).withColumn("_cy", span(F.col("_miny"), F.col("_maxy")))
    # segments are many rows of a small table: they meet the tiles by shuffle
    both = t.join(s.hint("merge"), ["epsg", "_cx", "_cy"]).select("scene_id", "_tr", "_tc", "g", "x0", "y0", "x1", "y1").distinct()
    kind = tiles.schema["scene_id"].dataType.simpleString()

    def draw(key: tuple, table: pa.Table) -> pa.Table:
        top, left = int(key[1].as_py()) * tile, int(key[2].as_py()) * tile
        g = [float(v) for v in table.column("g")[0].as_py()]
        inside = np.zeros((tile, tile), bool)
        for x0, y0, x1, y1 in zip(*(table.column(c).to_pylist() for c in ("x0", "y0", "x1", "y1")), strict=True):
            mark_near(inside, top, left, g, (x0, y0, x1, y1), max_dist)
        r, c = np.nonzero(inside)
        return pa.table([pa.repeat(key[0], len(r)), pa.array(r + top), pa.array(c + left)], names=["scene_id", "row", "col"])

    return both.groupBy("scene_id", "_tr", "_tc").applyInArrow(draw, f"scene_id {kind}, row long, col long")


def mark_near(inside: np.ndarray, top: int, left: int, g: list[float], segment: tuple[float, float, float, float], reach: float) -> None:
    """Marks the pixels of the bitmap (first pixel top, left) whose centre is within ``reach`` of the segment."""
    x0, y0, x1, y1 = segment
    det = g[1] * g[5] - g[2] * g[4]
    xs = np.array([min(x0, x1) - reach, max(x0, x1) + reach]).repeat(2) - g[0]
    ys = np.tile([min(y0, y1) - reach, max(y0, y1) + reach], 2) - g[3]
    rows, cols = (g[1] * ys - g[4] * xs) / det, (g[5] * xs - g[2] * ys) / det
    a, b = max(int(np.floor(rows.min())) - 1 - top, 0), min(int(np.ceil(rows.max())) + 1 - top, len(inside))
    c, d = max(int(np.floor(cols.min())) - 1 - left, 0), min(int(np.ceil(cols.max())) + 1 - left, inside.shape[1])
    if a >= b or c >= d:
        return
    row, col = np.arange(top + a, top + b)[:, None] + 0.5, np.arange(left + c, left + d)[None, :] + 0.5
    x, y = g[0] + col * g[1] + row * g[2], g[3] + col * g[4] + row * g[5]
    dx, dy = x1 - x0, y1 - y0
    square = dx * dx + dy * dy
    u = np.clip(((x - x0) * dx + (y - y0) * dy) / square, 0, 1) if square > 0 else 0.0
    inside[a:b, c:d] |= (x - x0 - u * dx) ** 2 + (y - y0 - u * dy) ** 2 <= reach * reach


def vertex_buffer(lines: DataFrame, grids: DataFrame, tiles: DataFrame, max_dist: float, tile: int = TILE) -> DataFrame:
    """scene_id, row, col within ``max_dist`` of a vertex of the lines, by whole pixels: each vertex goes to the nearest
    pixel corner of the scenes whose tiles it may reach, and a disk of ceil(max_dist / pixel) pixels is drawn about it."""
    v = in_zones(lines.select("lon", "lat")).select("epsg", "x", "y")
    span = lambda a, b: F.explode(F.sequence(F.floor(a / CELL), F.floor(b / CELL)))
    here = v.withColumn("_cx", F.floor(F.col("x") / CELL)).withColumn("_cy", F.floor(F.col("y") / CELL))
    t = _tile_boxes(tiles, grids, tile)
    t = t.withColumn("_cx", span(F.col("_minx") - max_dist, F.col("_maxx") + max_dist)).withColumn("_cy", span(F.col("_miny") - max_dist, F.col("_maxy") + max_dist))
    both = t.join(here.hint("merge"), ["epsg", "_cx", "_cy"])
    row, col = geo.world_to_pixel("x", "y", [F.col("g")[k] for k in range(6)])
    marks = both.select("scene_id", F.round(row).cast("long").alias("row"), F.round(col).cast("long").alias("col"), F.ceil(max_dist / F.abs(F.col("g")[1])).cast("int").alias("_r")).distinct()
    radii = [r._r for r in marks.select("_r").distinct().collect()]  # one for each pixel size
    out = None
    for r in radii:
        some = disks(marks.where(F.col("_r") == r).drop("_r"), r, ["scene_id"])
        out = some if out is None else out.unionByName(some)
    return marks.drop("_r") if out is None else out
