import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.operators.clip import clipped_area, plain_area


def one(spark, **columns):
    return spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).first()


def ring(*points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


SQUARE = ((0, 0), (4, 0), (4, 4), (0, 4))


def test_chainage_round_trip(spark):
    x, y = geo.at_chainage(7.0, 1.0, 2.0, 4.0, 6.0)
    along, across = geo.along_across(x, y, 1.0, 2.0, 4.0, 6.0)
    r = one(spark, along=along, across=across)
    assert math.isclose(r.along, 7) and abs(r.across) < 1e-12


def test_segment_distance(spark):
    r = one(spark, a=geo.segment_distance(2.0, 3.0, 0.0, 0.0, 4.0, 0.0), b=geo.segment_distance(7.0, 4.0, 0.0, 0.0, 4.0, 0.0), c=geo.segment_distance(3.0, 4.0, 0.0, 0.0, 0.0, 0.0))
    assert (r.a, r.b, r.c) == (3, 5, 5)


def test_rings(spark):
    r = one(spark, area=geo.ring_area(ring(*SQUARE)), closed=geo.ring_area(ring(*SQUARE, SQUARE[0])), inside=geo.in_ring(1.0, 1.0, ring(*SQUARE)), outside=geo.in_ring(5.0, 1.0, ring(*SQUARE)))
    assert (r.area, r.closed, r.inside, r.outside) == (16, 16, True, False)


def test_boxes(spark):
    r = one(spark, o=geo.box_overlap((0, 0, 2, 2), (1, 1, 5, 5)), none=geo.box_overlap((0, 0, 1, 1), (2, 2, 3, 3)), touch=geo.boxes_meet((0, 0, 1, 1), (1, 1, 2, 2)))
    assert (r.o, r.none, r.touch) == (1, 0, True)


def test_pixel_world_round_trip(spark):
    g = [100.0, 3.0, 0.5, 200.0, -0.25, -3.0]
    x, y = geo.pixel_to_world(12.5, 7.25, g)
    row, col = geo.world_to_pixel(x, y, g)
    r = one(spark, row=row, col=col)
    assert math.isclose(r.row, 12.5) and math.isclose(r.col, 7.25)


def test_utm_round_trip_and_zone(spark):
    grid = spark.range(0, 17).withColumn("lat", F.col("id") * 10.0 - 80).crossJoin(spark.range(0, 7).select((F.col("id") - 78.0).alias("lon")))
    epsg = geo.utm_epsg("lon", "lat")
    e, n = geo.to_utm("lon", "lat", epsg)
    lon, lat = geo.from_utm(e, n, epsg)
    worst = grid.select((F.abs(lon - F.col("lon")) * F.cos(F.radians("lat")) + F.abs(lat - F.col("lat"))).alias("d"), epsg.alias("z")).agg(F.max("d"), F.min("z"), F.max("z")).first()
    assert worst[0] * 111_000 < 1e-3
    assert (worst[1], worst[2]) == (32618, 32719)


def test_utm_known_values(spark):
    # on the equator and the central meridian; and the length of the meridian arc to 45 degrees
    e, n = geo.to_utm(F.lit(3.0), F.lit(0.0), 32631)
    _, arc = geo.to_utm(F.lit(3.0), F.lit(45.0), 32631)
    r = one(spark, e=e, n=n, arc=arc)
    assert abs(r.e - 500000) < 1e-6 and abs(r.n) < 1e-6 and abs(r.arc / 0.9996 - 4984944.378) < 1e-3


def test_zone_at_the_date_line(spark):
    assert one(spark, a=geo.utm_epsg(180.0, 1.0), b=geo.utm_epsg(180.0, 1.0, wrap=True)) == (32661, 32601)


def test_clipping(spark):
    df = spark.range(1).select(ring(*SQUARE).alias("ring")).union(spark.sql("select cast(null as array<struct<x:double,y:double>>)"))
    area = lambda region: [r[0] for r in df.select(clipped_area(region)("ring")).collect()]
    assert area([(2, -1), (9, -1), (9, 9), (2, 9)])[0] == pytest.approx(8)
    assert area([(7, 7), (9, 7), (9, 9)])[0] == 0
    got = area([(0, 0), (4, 0), (0, 4)])
    assert got[0] == pytest.approx(8) and got[1] is None


def test_clipping_by_a_region_that_is_not_convex_and_has_a_hole(spark):
    notched = [[(0, 0), (6, 0), (6, 6), (3, 1), (0, 6)], [(0.5, 0.2), (0.5, 0.8), (1, 0.8), (1, 0.2)]]
    rng = np.random.default_rng(3)
    at = (np.arange(1200) + 0.5) / 200  # a grid of points over the region's box
    x, y = (v.ravel() for v in np.meshgrid(at, at))

    def inside(p):
        odd = np.zeros(len(x), bool)
        for (ax, ay), (bx, by) in zip(p, p[1:] + p[:1], strict=True):
            if ay != by:
                odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        return odd

    region = inside(notched[0]) & ~inside(notched[1])
    assert plain_area(notched) == pytest.approx(20.7) and region.sum() / 40000 == pytest.approx(20.7, abs=0.02)
    rings = [[tuple(p) for p in rng.uniform(0, 6, (3, 2)).tolist()] for _ in range(12)] + [[(0.1, 0.1), (5.9, 0.3), (3.0, 0.6), (5.8, 5.0), (0.2, 4.0)]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], "i int, ring array<struct<x:double,y:double>>")
    for name in ("there", "back"):
        got = dict(df.select("i", clipped_area(notched if name == "there" else [r[::-1] for r in notched])("ring")).collect())
        for i, r in enumerate(rings):
            assert got[i] == pytest.approx((inside(r) & region).sum() / 40000, abs=0.03)
