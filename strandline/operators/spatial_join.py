"""Distance joins as equi-joins on grid cells with an exact residual."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import geometry as geo


def cell(v: Column | str, size: float) -> Column:
    return F.floor(geo.c(v) / size).cast("long")


def neighbour_cells(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Each row once in each of the nine cells about its own (_cx, _cy)."""
    near = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
    return df.withColumn("_cx", F.explode(F.transform(near, lambda d: cell(x, size) + d))).withColumn("_cy", F.explode(F.transform(near, lambda d: cell(y, size) + d)))


def corridor_cells(transects: DataFrame, along_dist: float, reach: float) -> DataFrame:
    """transect_id, x0, y0, x1, y1 once for each cell of side ``4 * along_dist`` (_cx, _cy) that may hold a point
    within ``along_dist`` of the transect's line and ``reach`` of its origin.

    The line is sampled once a cell side; such a point is nearer than a cell side to a sample, so the nine
    cells about the samples hold it.
    """
    size = 4 * along_dist
    length = geo.distance("x0", "y0", "x1", "y1")
    unit = lambda a, b: F.coalesce((F.col(b) - F.col(a)) / F.nullif(length, F.lit(0.0)), F.lit(0.0))
    steps = F.sequence(F.lit(-math.ceil(reach / size)), F.lit(math.ceil(reach / size)))
    near = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]

    def about(t: Column) -> Column:
        x, y = cell(F.col("x0") + t * size * F.col("_ux"), size), cell(F.col("y0") + t * size * F.col("_uy"), size)
        return F.array(*[F.struct((x + i).alias("x"), (y + j).alias("y")) for i, j in near])

    lines = transects.select("transect_id", "x0", "y0", "x1", "y1", unit("x0", "x1").alias("_ux"), unit("y0", "y1").alias("_uy"))
    lines = lines.withColumn("_c", F.explode(F.array_distinct(F.flatten(F.transform(steps, about)))))
    return lines.select("transect_id", "x0", "y0", "x1", "y1", F.col("_c.x").alias("_cx"), F.col("_c.y").alias("_cy"))


def points_on_transects(points: DataFrame, transects: DataFrame, along_dist: float = 25, reach: float = 1000) -> DataFrame:
    """Pairs of a point and a transect with chainage and offset: |offset| <= along_dist, at most ``reach`` from the origin.

    The transects, the smaller side, stand in the cells of their own corridors; a point stays in its own, and
    meets the few transects that pass near it.
    """
    size = 4 * along_dist
    here = points.withColumn("_cx", cell("x", size)).withColumn("_cy", cell("y", size))
    along, across = geo.along_across("x", "y", "x0", "y0", "x1", "y1")
    pairs = here.join(corridor_cells(transects, along_dist, reach), ["_cx", "_cy"]).withColumn("chainage", along).withColumn("offset", across)
    near = (F.abs("offset") <= along_dist) & (geo.distance("x0", "y0", "x", "y") <= reach)
    return pairs.where(near).drop("_cx", "_cy")


def away_from_mask(points: DataFrame, mask: DataFrame, threshold: float, by: list[str] | None = None) -> DataFrame:
    """Points with no mask point nearer than ``threshold`` (same ``by`` columns, such as the scene).

    The mask side is put in nine cells and the points keep their one: the other way round, a point would
    survive through any of its cells without a match.
    """
    by = by or []
    spots = neighbour_cells(mask.select(*by, F.col("x").alias("_mx"), F.col("y").alias("_my")).distinct(), "_mx", "_my", threshold)
    here = points.withColumn("_cx", cell("x", threshold)).withColumn("_cy", cell("y", threshold))
    on = [here[c].eqNullSafe(spots[c]) for c in by] + [here["_cx"] == spots["_cx"], here["_cy"] == spots["_cy"]]
    square = F.pow(here["x"] - spots["_mx"], 2) + F.pow(here["y"] - spots["_my"], 2)
    cond = square < threshold * threshold
    for c in on:
        cond = cond & c
    return here.join(spots, cond, "left_anti").drop("_cx", "_cy")


def transects_in_regions(transects: DataFrame, regions: DataFrame, size: float = 1000) -> DataFrame:
    """Transects that meet any region ring: an end inside it, or a crossing of one of its sides.

    The boxes of transects and regions stand in the cells of side ``size`` that they meet; the two meet by cell, then
    box, then ring, so neither side need be small. Transects alike in all columns are kept apiece.
    """
    b = geo.ring_bounds("ring")
    r = regions.select("ring", *[v.alias(f"_{k}") for k, v in b.items()])
    box = (F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1"))
    meets = geo.boxes_meet(box, tuple(F.col(f"_{k}") for k in ("minx", "miny", "maxx", "maxy")))
    ring = F.col("ring")
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))

    def side(ax, ay, bx, by, px, py):
        return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))

    x0, y0, x1, y1 = (F.col(k) for k in ("x0", "y0", "x1", "y1"))
    crosses = lambda p, q: (side(x0, y0, x1, y1, p.x, p.y) * side(x0, y0, x1, y1, q.x, q.y) <= 0) & (side(p.x, p.y, q.x, q.y, x0, y0) * side(p.x, p.y, q.x, q.y, x1, y1) <= 0)
    hit = geo.in_ring("x0", "y0", "ring") | F.exists(F.zip_with(ring, turned, crosses), lambda v: v)
    r = _in_cells(r, "_minx", "_miny", "_maxx", "_maxy", size)
    t = _in_cells(transects.withColumn("_lx", box[0]).withColumn("_ly", box[1]).withColumn("_hx", box[2]).withColumn("_hy", box[3]).withColumn("_row", F.monotonically_increasing_id()), "_lx", "_ly", "_hx", "_hy", size)
    same = (t["_cx"] == r["_cx"]) & (t["_cy"] == r["_cy"])
    return t.join(r, same & meets & hit, "left_semi").dropDuplicates(["_row"]).select(*transects.columns)


def _in_cells(df: DataFrame, minx: str, miny: str, maxx: str, maxy: str, size: float) -> DataFrame:
    """Each row once in each cell (_cx, _cy) that its box meets."""
    df = df.withColumn("_cx", F.explode(F.sequence(cell(minx, size), cell(maxx, size))))
    return df.withColumn("_cy", F.explode(F.sequence(cell(miny, size), cell(maxy, size))))


def resampled(target: DataFrame, source: DataFrame, target_grid: list, source_grid: list, value: str, missing, target_epsg: int | None = None, source_epsg: int | None = None) -> DataFrame:
    """target (scene_id, row, col) with the nearest source pixel's value, or ``missing`` where none covers it.

    A pixel's centre goes to the world, to the source's projection (UTM both ways) and to its pixel.
    """
    x, y = geo.pixel_to_world(F.col("row") + 0.5, F.col("col") + 0.5, target_grid)
    if target_epsg and source_epsg and target_epsg != source_epsg:
        lon, lat = geo.from_utm(x, y, target_epsg)
        x, y = geo.to_utm(lon, lat, source_epsg)
    r, k = geo.world_to_pixel(x, y, source_grid)
    at = target.withColumn("_r", F.floor(r)).withColumn("_c", F.floor(k))
    have = source.select("scene_id", F.col("row").cast("long").alias("_r"), F.col("col").cast("long").alias("_c"), F.col(value).alias("_v"))
    out = at.join(have, ["scene_id", "_r", "_c"], "left")
    return out.withColumn(value, F.coalesce("_v", F.lit(missing))).drop("_r", "_c", "_v")
