import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import spatial_join, transects


def frames(spark, seed=1):
    rng = np.random.default_rng(seed)
    t = [(f"t{i}", 100.0 * i, 0.0, 100.0 * i + 20, 300.0) for i in range(6)]
    p = [(dt.date(2024, 1, 1 + int(k)), float(x), float(y)) for k, x, y in zip(rng.integers(0, 9, 900), rng.uniform(-30, 560, 900), rng.choice([60, 80, 82, 85, 300, -150], 900) + rng.normal(0, 4, 900), strict=True)]
    return spark.createDataFrame(p, "date date, x double, y double"), spark.createDataFrame(t, "transect_id string, x0 double, y0 double, x1 double, y1 double"), p, t


def brute(p, t, mode):
    dates = sorted({d for d, _, _ in p})
    out = {}
    for tid, x0, y0, x1, y1 in t:
        a = np.array([x0, y0])
        u = (np.array([x1, y1]) - a) / np.hypot(x1 - x0, y1 - y0)
        stats = {}
        for d in dates:
            q = np.array([(x, y) for e, x, y in p if e == d]) - a
            ch, off = q @ u, q[:, 1] * u[0] - q[:, 0] * u[1]
            c = ch[(abs(off) <= 25) & (np.hypot(*q.T) <= 1000) & (ch >= -100)]
            if len(c) >= 3:
                stats[d] = (np.median(c), c.std(), c.min(), c.max())
        over = sum(s[1] > 15 for s in stats.values()) / len(dates) > 0.1
        for d, (med, sd, lo, hi) in stats.items():
            if sd <= 15 and hi - lo <= 30:
                out[tid, d] = med
            elif mode == "max" or (mode == "auto" and over):
                out[tid, d] = hi
    return out


@pytest.mark.parametrize("mode", transects.MODES)
def test_cross_distance_is_that_of_a_plain_loop(spark, mode):
    points, lines, p, t = frames(spark)
    got = {(r.transect_id, r.date): r.cross_distance for r in transects.cross_distance(points, lines, mode).collect()}
    want = brute(p, t, mode)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_unknown_mode(spark):
    points, lines, _, _ = frames(spark)
    with pytest.raises(ValueError):
        transects.cross_distance(points, lines, "other")


def test_wide_and_long(spark):
    points, lines, _, _ = frames(spark)
    s = transects.cross_distance(points, lines)
    back = {(r.dates, r.transect_id): r.cross_distance for r in transects.long(transects.wide(s)).collect()}
    assert back == {(r.date, r.transect_id): r.cross_distance for r in s.collect()}


def test_wide_blocks_hold_more_transects_than_a_pivot(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "100")
    s = spark.range(2500).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("date"), F.concat(F.lit("t"), F.floor(F.col("id") / 2)).alias("transect_id"), (F.col("id") / 4).alias("cross_distance"))
    s = s.unionByName(spark.createDataFrame([(dt.date(2024, 1, 1), "none", None)], s.schema))
    blocks = transects.wide_blocks(s, 300)
    back = sorted(map(tuple, transects.long_blocks(blocks).collect()))
    spark.conf.unset("spark.sql.pivotMaxValues")
    assert back == sorted((r.date, r.transect_id, r.cross_distance) for r in s.collect() if r.cross_distance is not None)
    rows = blocks.collect()
    assert len(rows) == 5 * 7 and sum(len(r.transect_ids) for r in rows) == 1250 * 7
    assert all(r.transect_ids == sorted(r.transect_ids) and len(r.transect_ids) == len(r.cross_distances) < 400 for r in rows)


def test_partitions_do_not_matter(spark):
    points, lines, _, _ = frames(spark)
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(tuple, transects.time_series(points, lines).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows[0] == rows[1] and len(rows[0]) > 10


def test_vertices_to_ends(spark):
    v = spark.createDataFrame([("a", 0, 0, 9.0, 9.0), ("a", 1, 0, 1.0, 2.0), ("a", 1, 1, 3.0, 4.0), ("a", 1, 2, 5.0, 6.0)], "transect_id string, part int, seq int, x double, y double")
    assert tuple(transects.end_points(v).first()) == ("a", 1, 2, 5, 6, 3, 4)


def test_off_transect_points_and_veto(spark):
    t = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 100.0), ("b", 50.0, 0.0, 50.0, 100.0), ("c", 90.0, 0.0, 90.0, 100.0)], "transect_id string, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame([(1, "a", 0.0, 10.0), (2, "a", 50.0, 10.0), (3, "b", 50.0, 20.0), (4, "b", 7.0, 7.0), (5, "c", 90.0, 5.0)], "row_id int, transect_id string, shore_x double, shore_y double")
    kept, dropped = transects.on_transects(p, t)
    assert sorted(r.row_id for r in kept.collect()) == [3, 5] and sorted(r.row_id for r in dropped.collect()) == [1, 2, 4]
    assert sorted(r.row_id for r in transects.on_transects(p, t, veto="row")[0].collect()) == [1, 3, 5]


def test_mask_distance_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    p, m = rng.uniform(-50, 50, (300, 2)), rng.uniform(-50, 50, (40, 2))
    df = lambda a: spark.createDataFrame([(int(i % 2), float(x), float(y)) for i, (x, y) in enumerate(a)], "scene_id int, x double, y double")
    got = {(r.scene_id, r.x, r.y) for r in spatial_join.away_from_mask(df(p), df(m), 7.0, ["scene_id"]).collect()}
    want = {(i % 2, *map(float, q)) for i, q in enumerate(p) if all(np.hypot(*(q - w)) >= 7 for j, w in enumerate(m) if j % 2 == i % 2)}
    assert got == want


def test_lines_by_nearest_neighbour(spark):
    p = spark.createDataFrame([("d", 0.0, 0.0), ("d", 5.0, 0.0), ("d", 1.0, 0.0), ("d", 1.0, 0.0), ("e", 1.0, 1.0)], "date string, x double, y double")
    assert [(r.date, r.x) for r in transects.dated_lines(p).orderBy("seq").collect()] == [("d", 0), ("d", 1), ("d", 5)]


def test_geometry_needs_points(spark):
    p = spark.createDataFrame([("a", [(0.0, 0.0)]), ("b", [(0.0, 0.0), (1.0, 1.0)])], "date string, points array<struct<x:double,y:double>>")
    assert [r.geometry is None for r in transects.geometry(p).orderBy("date").collect()] == [True, False]


def test_time_series_in_degrees(spark):
    points, lines, _, _ = frames(spark)
    shift = lambda df, *c: df.withColumns({k: F.col(k) + (400000.0 if k[0] == "x" else 4000000.0) for k in c})
    r = transects.time_series(shift(points, "x", "y"), shift(lines, "x0", "y0", "x1", "y1"), epsg=32618).first()
    assert -78 < r.shore_x < -75 and 36 < r.shore_y < 37 and -78 < r.x < -75


def test_the_walk_is_that_of_all_distances():
    rng = np.random.default_rng(1)
    for k in range(60):
        n = int(rng.integers(2, 200))
        p = np.unique(rng.integers(0, 12 + k, (n, 2)).astype(float) if k % 2 else rng.normal(size=(n, 2)), axis=0)
        left, order = np.ones(len(p), bool), [0]
        left[0] = False
        for _ in range(len(p) - 1):
            d = np.where(left, ((p - p[order[-1]]) ** 2).sum(1), np.inf)
            order.append(int(d.argmin()))
            left[order[-1]] = False
        assert transects.nearest_walk(p) == order


def test_a_date_of_many_points(spark):
    n = 100_000
    p = spark.range(n).select(F.lit(1).alias("date"), (F.col("id") * 7919 % n).cast("double").alias("x"), F.lit(0.0).alias("y"))
    got = transects.dated_lines(p)
    assert got.count() == n and got.where("seq <> x").isEmpty()
