"""Reference buffers in each scene's own zone and grid, against distances of every pixel."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.operators import contours, masks, reference

GRIDS = [(0, [500000.0, 3.0, 0.0, 4000000.0, 0.0, -3.0], 32618), (1, [500030.0, 10.0, 1.0, 3999900.0, 2.0, -10.0], 32618), (2, [960000.0, 3.0, 0.0, 4012500.0, 0.0, -3.0], 32617)]


def lonlat(spark, points, epsg=32618):
    lon, lat = geo.from_utm("x", "y", epsg)
    v = spark.createDataFrame([(0, k, float(x), float(y)) for k, (x, y) in enumerate(points)], "line_id int, seq int, x double, y double")
    return v.select("line_id", "seq", lon.alias("lon"), lat.alias("lat"))


@pytest.mark.parametrize("tile", [256, 16])
def test_pixels_near_a_line(spark, tile):
    ends = [(499990.0, 3999990.0), (500060.0, 3999950.0), (500061.0, 3999950.0), (503100.0, 3999955.0)]
    lines = lonlat(spark, ends)
    grids = spark.createDataFrame(GRIDS, "scene_id int, georef array<double>, epsg int")
    pixels = spark.createDataFrame([(s, r, c) for s in range(3) for r in range(40) for c in range(40)], "scene_id int, row long, col long")
    got = {tuple(r) for r in reference.line_buffer(lines, grids, reference.tiles_of(pixels, tile), 21.0, tile).join(pixels, ["scene_id", "row", "col"]).collect()}
    want = set()
    for s, g, epsg in GRIDS:
        x, y = geo.to_utm("lon", "lat", epsg)
        p = np.array([tuple(r) for r in lines.orderBy("seq").select(x, y).collect()])
        row, col = np.mgrid[0:40, 0:40] + 0.5
        at = np.stack([g[0] + col * g[1] + row * g[2], g[3] + col * g[4] + row * g[5]], -1)
        near = np.zeros((40, 40), bool)
        for a, b in zip(p, p[1:], strict=False):
            t = np.clip(((at - a) @ (b - a)) / ((b - a) @ (b - a)), 0, 1)
            near |= np.hypot(*np.moveaxis(at - a - t[..., None] * (b - a), -1, 0)) <= 21
        want |= {(s, int(r), int(c)) for r, c in zip(*np.nonzero(near), strict=True)}
    assert got == want and {s for s, _, _ in want} >= {0, 1}


def test_one_zone_by_another(spark):
    lines = lonlat(spark, [(100000.0, 3999990.0), (100300.0, 3999900.0)], 32618)
    x, y = geo.to_utm("lon", "lat", 32617)
    far = lines.select(x.alias("x"), y.alias("y")).first()
    grids = spark.createDataFrame([(5, [far.x - 30, 3.0, 0.0, far.y + 30, 0.0, -3.0], 32617)], "scene_id int, georef array<double>, epsg int")
    tiles = spark.createDataFrame([(5, 0, 0)], "scene_id int, _tr long, _tc long")
    got = {(r.row, r.col) for r in reference.line_buffer(lines, grids, tiles, 6.0).collect()}
    assert (9, 10) in got and (0, 0) not in got
    assert reference.line_buffer(lines.limit(1), grids, tiles, 6.0).count() == 0


def test_vertices_as_the_single_grid_draws_them(spark):
    ends = [(500030.0, 3999950.0), (500061.0, 3999971.0), (500100.0, 3999900.0)]
    g = [500000.0, 3.0, 0.0, 4000000.0, 0.0, -3.0]
    grids = spark.createDataFrame([(4, g, 32618)], "scene_id int, georef array<double>, epsg int")
    tiles = spark.createDataFrame([(4, 0, 0)], "scene_id int, _tr long, _tc long")
    got = {(r.row, r.col) for r in reference.vertex_buffer(lonlat(spark, ends), grids, tiles, 10.0).collect()}
    plain = spark.createDataFrame([(float(x), float(y)) for x, y in ends], "x double, y double")
    assert got == {(r.row, r.col) for r in masks.reference_buffer(plain, g, 256, 256, 10.0).collect()} != set()


def test_shorelines_near_the_line_only(spark):
    grid = np.zeros((40, 40), int)
    grid[:, 15:] = 3
    rows = [(0, r, c, int(grid[r, c])) for r in range(40) for c in range(40)]
    labels = spark.createDataFrame(rows, "scene_id int, row int, col int, label int")
    mask = labels.select("scene_id", "row", "col", F.lit(False).alias("shadow"), F.lit(False).alias("cloud"), F.lit(False).alias("nodata"))
    grids = spark.createDataFrame(GRIDS[:1], "scene_id int, georef array<double>, epsg int")
    lines = lonlat(spark, [(500000.0, 3999970.0), (500120.0, 3999970.0)])
    got = contours.shorelines(labels, mask, grids, least_patch=10, reference=lines, reference_dist=20.0).collect()
    assert got and {r.x for r in got} == {500000 + 14.5 * 3} and max(abs(r.y - 3999970) for r in got) <= 21.5 and len(got) < 20
    with pytest.raises(ValueError):
        contours.shorelines(labels, mask, GRIDS[0][1], reference=lines)


def test_segments_are_never_broadcast(spark):
    from strandline.operators import reference

    lines = spark.createDataFrame([(0, 0, -75.0, 36.0), (0, 1, -74.99, 36.0)], "line_id int, seq int, lon double, lat double")
    grids = spark.createDataFrame([(1, [500000.0, 3.0, 0.0, 3984000.0, 0.0, -3.0], 32618)], "scene_id int, georef array<double>, epsg int")
    tiles = spark.createDataFrame([(1, 0, 0)], "scene_id int, _tr long, _tc long")
    plan = reference.line_buffer(lines, grids, tiles)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [epsg" in plan
