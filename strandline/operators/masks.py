"""Cloud, shadow, no-data, elevation and water masks; erosion, dilation, buffers about a reference shoreline."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.functions.staging import dealt, staged, tasks_for
from strandline.operators import distance
from strandline.operators.spatial_join import cell

#: Bits of the quality band: dilated cloud, cirrus, cloud.
CLOUD_BITS = 0b1110


def in_band(z: Column | str, low: float, high: float) -> Column:
    """Strictly between; topobathy masks take -30 and 30."""
    return (geo.c(z) > low) & (geo.c(z) < high)


def qa_cloud(qa: Column | str, bits: int = CLOUD_BITS) -> Column:
    return geo.c(qa).bitwiseAND(F.lit(bits)) != 0


def bad_pixel(shadow: Column | str = "shadow", cloud: Column | str = "cloud", nodata: Column | str = "nodata") -> Column:
    return geo.c(shadow) | geo.c(cloud) | geo.c(nodata)


def cloud_or_shadow(shadow: Column | str = "shadow", cloud: Column | str = "cloud") -> Column:
    return geo.c(shadow) | geo.c(cloud)


def is_water(label: Column | str, classes: list[int] = (0, 1)) -> Column:
    """Water and whitewater count as water."""
    return geo.c(label).isin(list(classes))


def combined(labels: DataFrame, mask: DataFrame, water: Column, bad: Column) -> DataFrame:
    """scene_id, row, col, masked: water or bad, on the pixels that both have (the mask is cut to the labels' grid)."""
    key = ["scene_id", "row", "col"]
    a, b = labels.select(*key, water.alias("_w")), mask.select(*key, bad.alias("_b"))
    return a.join(b, key).select(*key, (F.col("_w") | F.col("_b")).alias("masked"))


def cloud_cover(pixels: DataFrame, cloud: Column) -> DataFrame:
    """scene_id, cloud_cover: share of cloud pixels to three places."""
    return pixels.groupBy("scene_id").agg(F.round(F.avg(cloud.cast("int")), 3).alias("cloud_cover"))


def without_specks(pixels: DataFrame, flag: str, least: int = 40) -> DataFrame:
    """Connected patches of under ``least`` true pixels become false, in scenes that have both values."""
    from strandline.operators.components import patches

    pixels, key = staged(pixels), ["scene_id", "row", "col"]
    tasks = tasks_for(pixels)
    big = patches(pixels.where(F.col(flag)).select(*key), least=least, tasks=tasks).select("scene_id", "row", "col", F.lit(True).alias("_big"))
    mixed = pixels.groupBy("scene_id").agg((F.min(F.col(flag).cast("int")) < F.max(F.col(flag).cast("int"))).alias("_mixed"))
    out = dealt(pixels, tasks, *key).join(dealt(big, tasks, *key), key, "left").join(mixed, "scene_id")
    return out.withColumn(flag, F.when(F.col("_mixed"), F.coalesce("_big", F.lit(False))).otherwise(F.col(flag))).drop("_big", "_mixed")


def cloud_mask(pixels: DataFrame, opening: int = 6, least: int = 40) -> DataFrame:
    """scene_id, row, col, cloud: quality bits, opened by a square, without specks."""
    raw = pixels.select("scene_id", "row", "col", qa_cloud("qa").alias("cloud"))
    return without_specks(opened(raw, "cloud", opening), "cloud", least)


def _tiled(pixels: DataFrame, tile: int, halo: int) -> DataFrame:
    """Each pixel in its own tile and, within ``halo`` of a border, in the neighbours' too (_tr, _tc; _own)."""
    span = lambda v: F.sequence(F.floor((F.col(v) - halo) / tile), F.floor((F.col(v) + halo) / tile))
    out = pixels.withColumn("_tr", F.explode(span("row"))).withColumn("_tc", F.explode(span("col")))
    own = (F.floor(F.col("row") / tile) == F.col("_tr")) & (F.floor(F.col("col") / tile) == F.col("_tc"))
    return out.withColumn("_own", own)


def opened(pixels: DataFrame, flag: str, size: int = 6, tile: int = 256) -> DataFrame:
    """Binary opening by a ``size`` x ``size`` square: a pixel stays true if some all-true square covers it.

    Erosion and dilation are window frames over row and column, one after the other, inside tiles with a
    halo, so a partition holds tiles and never a whole scene. Pixels outside the scene count as true when
    eroding, as in image libraries, which the frames' ends give by themselves.
    """
    key = ["scene_id", "_tr", "_tc"]
    t = _tiled(pixels.withColumn("_v", F.col(flag).cast("int")), tile, 2 * size).repartition(tasks_for(pixels), *key)
    along = lambda a, b: Window.partitionBy(*key, a).orderBy(b).rangeBetween
    t = t.withColumn("_v", F.min("_v").over(along("row", "col")(0, size - 1)))
    t = t.withColumn("_v", F.min("_v").over(along("col", "row")(0, size - 1)))
    t = t.withColumn("_v", F.max("_v").over(along("row", "col")(-(size - 1), 0)))
    t = t.withColumn("_v", F.max("_v").over(along("col", "row")(-(size - 1), 0)))
    return t.where("_own").withColumn(flag, F.col("_v") == 1).drop("_v", "_tr", "_tc", "_own")


def dilated(marks: DataFrame, radius: int, n_rows: int | None = None, n_cols: int | None = None, by: list[str] = ("scene_id",)) -> DataFrame:
    """Pixels within ``radius`` of a marked pixel (by, row, col), by a distance transform on tiles."""
    out = distance.dilated(marks, radius, list(by))
    if n_rows is not None:
        out = out.where(F.col("row").between(0, n_rows - 1) & F.col("col").between(0, n_cols - 1))
    return out


def reference_buffer(vertices: DataFrame, georef: list[float], n_rows: int, n_cols: int, max_dist: float, by: list[str] = ()) -> DataFrame:
    """row, col of the pixels within ``max_dist`` of a reference vertex: vertices to whole pixels, those strictly
    inside the grid dilated by a disk. Only vertices are marked, not the line between them."""
    row, col = geo.world_to_pixel("x", "y", georef)
    at = vertices.select(*by, F.round(row).cast("int").alias("row"), F.round(col).cast("int").alias("col"))
    at = at.where((F.col("row") > 0) & (F.col("row") < n_rows) & (F.col("col") > 0) & (F.col("col") < n_cols))
    return dilated(at, math.ceil(max_dist / abs(georef[1])), n_rows, n_cols, by)


def grid_over(vertices: DataFrame, georef: list[float], max_dist: float) -> tuple[int, int]:
    """Rows and columns of the grid from pixel (0, 0) that holds every vertex and its buffer."""
    row, col = geo.world_to_pixel("x", "y", georef)
    last = vertices.agg(F.max(F.round(row)).alias("row"), F.max(F.round(col)).alias("col")).first()
    more = math.ceil(max_dist / abs(georef[1])) + 1
    return int(last.row or 0) + more, int(last.col or 0) + more


def line_buffer(pixels: DataFrame, vertices: DataFrame, georef: list[float], max_dist: float = 100) -> DataFrame:
    """Pixels (scene_id, row, col) whose centre is within ``max_dist`` of the reference lines (line_id, seq, x, y).

    Segments stand in every cell of size ``max_dist`` that their grown box meets; a pixel looks in its own.
    """
    w = Window.partitionBy("line_id").orderBy("seq")
    seg = vertices.select("x", "y", F.lead("x").over(w).alias("x1"), F.lead("y").over(w).alias("y1")).where("x1 is not null").toDF("x0", "y0", "x1", "y1")
    for k, a, b in (("_cx", "x0", "x1"), ("_cy", "y0", "y1")):
        seg = seg.withColumn(k, F.explode(F.sequence(cell(F.least(a, b) - max_dist, max_dist), cell(F.greatest(a, b) + max_dist, max_dist))))
    x, y = geo.pixel_to_world(F.col("row") + 0.5, F.col("col") + 0.5, georef)
    here = pixels.withColumn("_x", x).withColumn("_y", y)
    here = here.withColumn("_cx", cell("_x", max_dist)).withColumn("_cy", cell("_y", max_dist))
    near = geo.segment_distance("_x", "_y", "x0", "y0", "x1", "y1") <= max_dist
    cond = (here["_cx"] == seg["_cx"]) & (here["_cy"] == seg["_cy"]) & near
    return here.join(seg, cond, "left_semi").drop("_x", "_y", "_cx", "_cy")


def in_world(pixels: DataFrame, georef: list[float] | DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the world coordinates x, y of (row, col): by one georeference, or by each scene's own from a
    table (scene_id, georef, ..)."""
    if isinstance(georef, DataFrame):
        pixels = pixels.join(georef.select("scene_id", F.col("georef").alias("_g")), "scene_id")
        georef = [F.col("_g")[i] for i in range(6)]
    x, y = geo.pixel_to_world(F.col("row"), F.col("col"), georef)
    return pixels.select(*keep, x.alias("x"), y.alias("y"))


def clipped(pixels: DataFrame, ring: list[tuple[float, float]] | list[list[tuple[float, float]]], georef: list[float] | DataFrame, value: str = "dn") -> DataFrame:
    """Pixels of the region's box, with 0 where their centre is outside the region.

    The region is a ring, or several: holes and parts, of which a point is inside by the even-odd rule. With one
    georeference the box is a plain range on row and col, which a scan can prune by; with a table (scene_id,
    georef, ..) each scene has its own box. An empty result means that the region does not meet the scene.
    """
    rings = ring if isinstance(ring[0], list) else [ring]
    flat = [p for r in rings for p in r]
    columns = pixels.columns
    if isinstance(georef, DataFrame):
        pixels = pixels.join(georef.select("scene_id", F.col("georef").alias("_g")), "scene_id")
        g = [F.col("_g")[i] for i in range(6)]
        corners = [geo.world_to_pixel(F.lit(float(a)), F.lit(float(b)), g) for a, b in flat]
        box = F.lit(True)
        for k, name in enumerate(("row", "col")):
            at = [c[k] for c in corners]
            box = box & (F.col(name) >= F.floor(F.least(*at))) & (F.col(name) <= F.ceil(F.greatest(*at)) - 1)
    else:
        g = georef
        corners = [_pixel(p, georef) for p in flat]
        lo_r, hi_r = math.floor(min(r for r, _ in corners)), math.ceil(max(r for r, _ in corners))
        lo_c, hi_c = math.floor(min(k for _, k in corners)), math.ceil(max(k for _, k in corners))
        box = F.col("row").between(lo_r, hi_r - 1) & F.col("col").between(lo_c, hi_c - 1)
    x, y = geo.pixel_to_world(F.col("row") + 0.5, F.col("col") + 0.5, g)
    times = sum((geo.in_ring(x, y, F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in r])).cast("int") for r in rings), F.lit(0))
    return pixels.where(box).withColumn(value, F.when(times % 2 == 1, F.col(value)).otherwise(0)).select(*columns)


def _pixel(p: tuple[float, float], g: list[float]) -> tuple[float, float]:
    det = g[1] * g[5] - g[2] * g[4]
    u, v = p[0] - g[0], p[1] - g[3]
    return (g[1] * v - g[4] * u) / det, (g[5] * u - g[2] * v) / det
