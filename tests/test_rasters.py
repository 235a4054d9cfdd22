import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import components, contours, labels, masks, radiometry, spatial_join


def pixels(spark, grid, scene=0, column="value"):
    rows = [(scene, r, c, None if np.isnan(v) else float(v)) for r, line in enumerate(grid) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, f"scene_id int, row int, col int, {column} double")


def lines(spark, grid):
    out = {}
    for r in contours.chained(contours.segments(pixels(spark, np.array(grid, float)))).orderBy("seq").collect():
        out.setdefault((r.contour_id, r.part), []).append((r.row, r.col))
    return list(out.values())


def test_square_gives_a_ring_of_twelve(spark):
    g = np.zeros((5, 5))
    g[1:4, 1:4] = 1
    (ring,) = lines(spark, g)
    assert len(ring) == 13 and ring[0] == ring[-1]


def test_block_at_the_border_gives_an_open_line(spark):
    g = np.zeros((4, 4))
    g[:3, :3] = 1
    (line,) = lines(spark, g)
    assert line[0] != line[-1]


def test_saddle_gives_two_segments(spark):
    got = lines(spark, [[1, 0], [0, 1]])
    assert sorted(len(x) for x in got) == [2, 2]


def test_ring_with_a_hole(spark):
    g = np.zeros((7, 7))
    g[1:6, 1:6] = 1
    g[3, 3] = 0
    assert len(lines(spark, g)) == 2
    p = components.patches(pixels(spark, g).where("value = 1"), tile=3)
    assert p.select("component").distinct().count() == 1 and p.count() == 24


def test_missing_value_blanks_four_cells(spark):
    g = np.zeros((5, 5))
    g[:, 3:] = 1
    g[2, 2] = np.nan
    assert contours.cells(pixels(spark, g)).count() == 16 - 4


def test_tiled_components_are_those_of_one_tile(spark):
    rng = np.random.default_rng(5)
    g = (rng.random((40, 40)) < 0.6).astype(float)
    true = pixels(spark, g).where("value = 1")
    rows = [sorted((r.row, r.col, r.component, r.size) for r in components.patches(true, tile=t).collect()) for t in (64, 8)]
    assert rows[0] == rows[1] and len(rows[0]) == g.sum()
    flood = {}
    for r, c in zip(*np.nonzero(g), strict=True):
        if (r, c) in flood:
            continue
        stack, own = [(r, c)], []
        while stack:
            q = stack.pop()
            if q in flood or not (0 <= q[0] < 40 and 0 <= q[1] < 40) or not g[q]:
                continue
            flood[q] = r * components.ROW + c
            own.append(q)
            stack += [(q[0] + 1, q[1]), (q[0] - 1, q[1]), (q[0], q[1] + 1), (q[0], q[1] - 1)]
    assert {(r, c): k for r, c, k, _ in rows[0]} == flood


@pytest.mark.parametrize("size, survives", [(5, False), (6, True)])
def test_opening_by_six(spark, size, survives):
    g = np.zeros((20, 20))
    g[7 : 7 + size, 7 : 7 + size] = 1
    p = pixels(spark, g).withColumn("flag", F.col("value") == 1)
    for tile in (64, 8):
        got = {(r.row, r.col) for r in masks.opened(p, "flag", 6, tile).where("flag").collect()}
        assert got == ({(r, c) for r, c in zip(*map(list, np.nonzero(g)), strict=True)} if survives else set())


def test_specks(spark):
    g = np.zeros((9, 9))
    g[0, 0] = 1
    g[3:6, 3:6] = 1
    p = pixels(spark, g).withColumn("flag", F.col("value") == 1)
    assert masks.without_specks(p, "flag", 4).where("flag").count() == 9
    every = pixels(spark, np.ones((1, 2))).withColumn("flag", F.lit(True))
    assert masks.without_specks(every, "flag", 40).where("flag").count() == 2


def test_dilation(spark):
    one = spark.createDataFrame([(0, 0, 0)], "scene_id int, row int, col int")
    assert masks.dilated(one, 1, 5, 5).count() == 3


def test_clip_to_a_ring(spark):
    p = pixels(spark, np.ones((4, 4)), column="dn")
    got = masks.clipped(p, [(0, 0), (2, 0), (2, -2), (0, -2)], [0.0, 1.0, 0.0, 0.0, 0.0, -1.0])
    assert got.count() == 4 and got.agg(F.sum("dn")).first()[0] == 4


def test_radiometry(spark):
    p = spark.createDataFrame([(0, 0, 0, 1, 1000), (0, 0, 1, 1, 3000), (0, 0, 0, 2, 7), (0, 0, 1, 2, 7)], "scene_id int, row int, col int, band int, dn int")
    s = {(r.band, r.dn): r.stretched for r in radiometry.stretched(p).collect()}
    assert s == {(1, 1000): 0, (1, 3000): 255, (2, 7): 0}
    assert sorted(r.band for r in radiometry.to_rgb(p).collect()) == [2, 2, 3, 3]
    k = spark.createDataFrame([(1, 2.0)], "band int, coeff double")
    assert radiometry.reflectance(p, k).where("toa is not null").count() == 0
    assert radiometry.reflectance(p, k, overflow="wrap").count() == 2 and radiometry.reflectance(p, k, missing=1e-4).where("band = 2").first().toa == 7
    f = spark.createDataFrame([(0.5,), (float("inf"),), (0.00019,)], "v double")
    assert [r[0] for r in f.select(radiometry.scaled_float(F.col("v"))).collect()] == [5000, 0, 1]


def test_otsu_parts_two_heaps(spark):
    v = spark.createDataFrame([(0, float(x)) for x in [1, 2, 3] * 10 + [11, 12, 13] * 10] + [(1, 5.0)], "g int, v double")
    got = {r.g: r.threshold for r in radiometry.otsu(v, ["g"], "v").collect()}
    # the threshold is the centre of the bucket, 12 / 256 wide, that ends the lower heap
    assert abs(got[0] - 3) < 12 / 256 and got[1] == 5
    assert radiometry.thresholded(v, ["g"], "v").where("label = 1 and v > 10").count() == 30
    assert radiometry.thresholded(v, ["g"], "v").where("label = 1 and v < 3").count() == 0
    assert radiometry.thresholded(v, ["g"], "v", use_otsu=False).where("label = 1").count() == 61


def test_labels(spark):
    s = spark.createDataFrame([(0, 0, 0, 0, 0.5), (0, 0, 0, 1, 0.5), (0, 0, 1, 0, 0.1), (0, 0, 1, 1, 0.9), (1, 0, 0, 0, 0.3), (1, 0, 0, 1, 0.3)], "scene_id int, row int, col int, class_idx int, score double")
    assert {(r.scene_id, r.col): r.label for r in labels.argmax(s).collect()} == {(0, 0): 0, (0, 1): 1, (1, 0): 0}


def test_resampling_through_projections(spark):
    p = pixels(spark, np.arange(16).reshape(4, 4), column="v")
    g = [500000.0, 30.0, 0.0, 4000000.0, 0.0, -30.0]
    same = spatial_join.resampled(p.select("scene_id", "row", "col"), p, g, g, "v", -1.0)
    assert {(r.row, r.col): r.v for r in same.collect()} == {(r.row, r.col): r.v for r in p.collect()}
    far = spatial_join.resampled(p.select("scene_id", "row", "col"), p, [600000.0, *g[1:]], g, "v", -1.0)
    assert far.where("v <> -1").count() == 0


def test_shoreline_pipeline(spark):
    g = np.zeros((30, 30), int)
    g[:, 15:] = 3
    g[5, 3] = 3
    lab = spark.createDataFrame([(0, r, c, int(g[r, c])) for r in range(30) for c in range(30)], "scene_id int, row int, col int, label int")
    udm = lab.select("scene_id", "row", "col", F.lit(False).alias("shadow"), (F.col("row") > 25).alias("cloud"), F.lit(False).alias("nodata"))
    got = contours.shorelines(lab, udm, [0.0, 3.0, 0.0, 0.0, 0.0, -3.0], least_patch=10, cloud_dist=10.0).orderBy("seq").collect()
    assert {r.x for r in got} == {14.5 * 3} and max(-r.y for r in got) <= 26 * 3 - 10 and len(got) > 15
    assert contours.split_gaps(spark.createDataFrame([(0, 1), (0, 2), (0, 5)], "k int, seq int"), ["k"]).select("piece").distinct().count() == 2


def test_contour_cleanup(spark):
    nan = float("nan")
    v = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, nan, nan), (2, 0, 0.0, 0.0), (2, 1, nan, 1.0), (2, 2, 3.0, 4.0)], "k int, seq int, x double, y double")
    c = contours.clean(v, ["k"])
    assert sorted((r.k, r.seq) for r in c.collect()) == [(2, 0), (2, 2)]
    assert contours.long_enough(c, 5.0, ["k"]).count() == 2 and contours.long_enough(c, 5.1, ["k"]).count() == 0


def test_shorelines_by_each_scenes_own_grid_come_out_in_one_projection(spark):
    from strandline.functions import geometry as geo

    g = np.zeros((30, 30), int)
    g[:, 15:] = 3
    lab = spark.createDataFrame([(k, r, c, int(g[r, c])) for k in (0, 1) for r in range(30) for c in range(30)], "scene_id int, row int, col int, label int")
    udm = lab.select("scene_id", "row", "col", F.lit(False).alias("shadow"), (F.col("row") > 25).alias("cloud"), F.lit(False).alias("nodata"))
    refs = {0: ([500000.0, 3.0, 0.0, 4000000.0, 0.0, -3.0], 32618), 1: ([900000.0, 3.0, 0.0, 4000100.0, 0.0, -3.0], 32617)}
    table = spark.createDataFrame([(k, *v) for k, v in refs.items()], "scene_id int, georef array<double>, epsg int")
    both = contours.shorelines(lab, udm, table, least_patch=10, cloud_dist=10.0, epsg=32618)
    for k, (ref, epsg) in refs.items():
        alone = contours.shorelines(lab.where(F.col("scene_id") == k), udm, ref, least_patch=10, cloud_dist=10.0)
        lon, lat = geo.from_utm("x", "y", epsg)
        x, y = geo.to_utm("lon", "lat", 32618)
        want = alone.withColumn("lon", lon).withColumn("lat", lat).select("seq", x.alias("x"), y.alias("y")).orderBy("seq").collect()
        got = both.where(F.col("scene_id") == k).orderBy("seq").collect()
        assert [r.seq for r in got] == [r.seq for r in want] and len(got) > 15
        assert np.allclose([(r.x, r.y) for r in got], [(r.x, r.y) for r in want], atol=1e-3)
    with pytest.raises(ValueError):
        contours.shorelines(lab, udm, refs[0][0], epsg=32618)


def test_pixels_are_dealt_by_rows_and_not_broadcast(spark, monkeypatch):
    from strandline.functions import staging
    from strandline.operators import components, masks

    assert [staging.tasks_for(spark.range(n), 10) for n in (0, 10, 11)] == [1, 1, 2]
    for module in (components, masks):
        monkeypatch.setattr(module, "tasks_for", lambda df: 7)
    p = spark.range(400).selectExpr("1 AS scene_id", "cast(id div 20 as int) AS row", "cast(id % 20 as int) AS col", "id % 20 < 3 AS cloud")
    out = masks.without_specks(masks.opened(p, "cloud", 2).unionByName(p.limit(0)), "cloud", 40)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(scene_id" in plan and ", 7)" in plan and "SortMergeJoin [scene_id" in plan
    assert out.where("cloud").count() == 60
    assert components.patches(p.where("cloud").union(p.where("cloud"))).groupBy("size").count().collect() == [(60, 60)]
