"""The tiled distance transform against all pairs: dilation, squared distances, points in halves of a pixel."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import contours, distance, masks, spatial_join


def marks(spark, n=60, size=90, seed=2):
    at = np.random.default_rng(seed).integers(-5, size, (n, 2)).tolist()
    return at, spark.createDataFrame([(k % 2, r, c) for k, (r, c) in enumerate(at + at[:9])], "scene_id int, row int, col int")


@pytest.mark.parametrize("reach,tile", [(1, 256), (5, 16), (12, 7), (70, 256)])
def test_distances_are_those_of_all_pairs(spark, monkeypatch, reach, tile):
    monkeypatch.setattr(distance, "tile_for", lambda r: tile)
    at, table = marks(spark)
    got = {(r.scene_id, r.row, r.col): r.square for r in distance.distances(table, reach).collect()}
    span = np.arange(-5 - reach, 90 + reach)
    want = {}
    for scene in (0, 1):
        own = np.array([p for k, p in enumerate(at + at[:9]) if k % 2 == scene])
        d = ((span[:, None, None, None] - own[:, 0]) ** 2 + (span[None, :, None, None] - own[:, 1]) ** 2).min(-1)[..., 0]
        want |= {(scene, int(span[i]), int(span[j])): int(d[i, j]) for i, j in zip(*np.nonzero(d <= reach * reach))}
    assert got == want
    assert {tuple(r) for r in masks.dilated(table, reach).collect()} == set(want)
    assert masks.dilated(table, reach).count() == len(want)


def test_rows_moved_do_not_depend_on_the_reach(spark):
    _, table = marks(spark, 500, 4000)
    for reach in (3, 60, 300):
        tile = distance.tile_for(reach)
        assert distance.in_tiles(table, tile, reach).count() <= 2.6 * table.count()


@pytest.mark.parametrize("tile", [None, 9])
def test_points_near_a_mask(spark, tile):
    rng = np.random.default_rng(6)
    at, table = marks(spark, 25, 60)
    mask = table.withColumn("cloud", F.col("row") % 2 == 0).withColumn("nodata", F.col("col") % 3 == 0)
    points = [(k % 2, float(r) / 2, float(c) / 2, k) for k, (r, c) in enumerate(rng.integers(-20, 130, (300, 2)))]
    p = spark.createDataFrame(points, "scene_id int, row double, col double, id int").withColumns({"tall": F.lit(3.0), "wide": F.lit(2.0), "least_cloud": F.lit(9.0), "least_nodata": F.when(F.col("scene_id") == 1, 4.0).otherwise(0.0)})
    got = {r.id for r in distance.away_from_pixels(p, mask, 5, tile).collect()}
    rows = [(k % 2, r, c) for k, (r, c) in enumerate(at + at[:9])]
    near = lambda s, r, c, flag, least: any(s == m[0] and flag(m) and ((r - m[1]) * 3) ** 2 + ((c - m[2]) * 2) ** 2 < least**2 for m in rows)
    want = {k for s, r, c, k in points if not near(s, r, c, lambda m: m[1] % 2 == 0, 9.0) and not near(s, r, c, lambda m: m[2] % 3 == 0, 4.0 if s else 0.0)}
    assert got == want and 0 < len(want) < 300


def test_both_ways_of_measuring_agree(spark):
    rng = np.random.default_rng(9)
    flags = spark.createDataFrame([(0, int(r), int(c), bool(k % 3), bool(k % 2)) for k, (r, c) in enumerate(rng.integers(0, 40, (20, 2)))], "scene_id int, row int, col int, cloud boolean, nodata boolean")
    v = spark.createDataFrame([(0, float(r) / 2, float(c) / 2) for r, c in rng.integers(0, 80, (200, 2))], "scene_id int, row double, col double")
    georef = [500.0, 3.0, 0.0, 900.0, 0.0, -3.0]
    v = masks.in_world(v, georef, ["scene_id", "row", "col"])
    got = contours._away(v, flags, georef, {"nodata": 7.0, "cloud": 11.0})
    want = v.drop("row", "col")
    for name, least in (("nodata", 7.0), ("cloud", 11.0)):
        want = spatial_join.away_from_mask(want, masks.in_world(flags.where(name), georef, ["scene_id"]), least, ["scene_id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
    askew = [500.0, 3.0, 1e-12, 900.0, 0.0, -3.0]
    assert contours._away(v, flags, askew, {"nodata": 7.0, "cloud": 11.0}).count() == got.count()
