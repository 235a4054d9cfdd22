import datetime as dt

import pytest
from pyspark.sql import functions as F

from strandline.functions import names
from strandline.operators import quality, scenes


def items(spark, rows):
    return spark.createDataFrame([(i, s, dt.date.fromisoformat(d), c) for i, (s, d, c) in enumerate(rows)], "seq int, scene_id string, acquired date, cloud_cover double")


def test_ids_follow_dates(spark):
    df = items(spark, [("5", "2023-06-27", 0.0), ("1", "2023-06-28", 0.0), ("3", "2023-06-29", 0.0), ("2", "2023-06-30", 0.0), ("4", "2023-07-01", 0.0)])
    assert [r.scene_id for r in scenes.ordered_ids(df).collect()] == ["5", "1", "3", "2", "4"]
    assert [r.scene_id for r in scenes.ordered_ids(df, ["07"]).collect()] == ["4"]
    assert scenes.ordered_ids(df.limit(0)).count() == 0


def test_ids_by_date(spark):
    df = items(spark, [("1", "2023-06-27", 0.0), ("2", "2023-06-27", 0.0), ("3", "2023-06-28", 0.0), ("4", "2023-06-28", 0.0), ("5", "2023-06-29", 0.0)])
    assert {str(r.date): r.ids for r in scenes.ids_by_date(df).collect()} == {"2023-06-27": ["1", "2"], "2023-06-28": ["3", "4"], "2023-06-29": ["5"]}
    assert scenes.with_date_ids(df, [dt.date(2023, 6, 29)]).count() == 1


def test_orders_by_name_and_state(spark):
    df = spark.createDataFrame([("order1", "success", "o1"), ("order2", "success", "o2"), ("order1_batch_2_499", "success", "o3"), ("order11", "success", "o4")], "name string, state string, order_id string")
    ids = lambda *a: sorted(r.order_id for r in scenes.matching_orders(df, *a).collect())
    assert ids("order1") == ["o1", "o3"]
    assert ids("order1", ["failed"]) == []
    assert ids("other") == []


def test_coregistration_choice(spark):
    df = items(spark, [("1", "2023-06-27", 0.2), ("2", "2023-06-27", 0.1), ("3", "2023-06-28", 0.3)])
    pick = lambda *a: scenes.coregister_choice(df, *a).first().scene_id
    assert pick(False) == ""
    assert pick(True, "3") == "3"
    assert pick(True) == "2"
    with pytest.raises(Exception, match="not among the scenes"):
        pick(True, "4")


def test_least_cloud_without_covers(spark):
    assert scenes.least_cloud(items(spark, [("1", "2023-06-27", None)])).first().scene_id is None


def test_tools(spark):
    df = spark.createDataFrame([(["clip", "toar"],), (["  CLIP  ", "ToAr"],), (["clip", "foo"],), ([],)], "tools array<string>")
    known, other = names.known_tools(F.col("tools"))
    got = [(r[0], r[1]) for r in df.select(known, other).collect()]
    assert got == [(["clip", "toar"], []), (["clip", "toar"], []), (["clip"], ["foo"]), ([], [])]


def test_batches(spark):
    df = items(spark, [(str(i), f"2023-06-{27 - i % 2}", 0.0) for i in range(7)])
    got = sorted((r.batch, r.name, r.ids) for r in scenes.batches(df, "base", 3, "x").collect())
    assert got == [(1, "base_batch_1_4", ["1", "3", "5", "x"]), (2, "base_batch_2_4", ["0", "2", "4", "x"]), (3, "base_batch_3_2", ["6", "x"])]


def test_specification_rules(spark):
    cols = "start_date string, end_date string, cloud_cover double, min_area_percentage double, roi_path string"
    df = spark.createDataFrame([("2023-01-01", "2023-02-01", 0.5, 0.5, "a.geojson"), ("2023-03-01", "2023-02-01", 1.5, 0.5, "a.json"), ("x", None, 0.1, None, "a.geojson")], cols)
    got = [r.violations for r in scenes.violations(df).collect()]
    assert got[0] == [] and len(got[1]) == 3 and len(got[2]) == 4


def test_names(spark):
    n = F.lit("20230610_145046_77_2459_3B_AnalyticMS.tif")
    r = spark.range(1).select(names.base_name(n), names.scene_id(n), names.name_date(n), names.sensor_suffix(F.lit("PS2.SD")), names.sensor_suffix(F.lit("?")), names.acquired_date(F.lit("2023-06-16T15:30:32Z"))).first()
    assert tuple(r) == ("20230610_145046_77_2459", "20230610_145046_77_2459", "2023-06-10-14-50-46", "_2SD_TOA.tif", "_UNKNOWN_TOA.tif", "2023-06-16")
    with pytest.raises(Exception, match="no _3B"):
        spark.range(1).select(names.base_name(F.lit("abc"))).collect()


def test_sensor_priority_and_completeness(spark):
    f = spark.createDataFrame([("L9", "meta"), ("L8", "meta"), ("L8", "ms"), ("L8", "mask"), ("L7", "meta"), ("L7", "ms"), ("L7", "mask")], "sensor string, kind string")
    assert scenes.best_sensor(f).first().sensor == "L8"
    p = spark.createDataFrame([("a", "a/S/1.tif"), ("a", "a/S/1.xml"), ("a", "a/S/1.json"), ("b", "b/1.tif"), ("b", "b/S/1.xml"), ("b", "b/S/1.json")], "order_id string, path string")
    assert {r.order_id: r.complete for r in scenes.complete_orders(p, "S").collect()} == {"a": True, "b": False}


def test_area_sides(spark):
    f = spark.createDataFrame([(1, 0.0, 1000.0, 0.0, 1000.0), (2, 0.0, 100.0, 0.0, 1000.0), (3, None, None, None, None)], "i int, left double, right double, bottom double, top double")
    ok, bad = scenes.big_enough(f, 1.0)
    assert [r.i for r in ok.collect()] == [1] and sorted(r.i for r in bad.collect()) == [2, 3]


def test_verdicts(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 0.0), ("c", -1.0)], "im_paths string, logit double")
    v = quality.verdicts(df)
    assert {r.im_paths: r.im_classes for r in v.collect()} == {"a": "good", "b": "bad", "c": "bad"}
    old = spark.createDataFrame([("a", "old")], "im_paths string, im_classes string")
    merged = quality.merged(old, v.select("im_paths", "im_classes"))
    assert {r.im_paths: r.im_classes for r in merged.collect()} == {"a": "old", "b": "bad", "c": "bad"}
    assert sorted(r.im_paths for r in quality.not_yet_scored(df, old).collect()) == ["b", "c"]
    assert [r.im_paths for r in quality.good(v).collect()] == ["a"]


def test_coverage_tells_far_footprints_by_their_box(spark):
    from strandline.operators import scenes

    square = lambda x: [(x, 0.0), (x + 1.0, 0.0), (x + 1.0, 1.0), (x, 1.0)]
    items = spark.createDataFrame([(0, square(0.0)), (1, square(0.4)), (2, square(0.6)), (3, square(1.0)), (4, None)], "scene_id int, ring array<struct<x: double, y: double>>")
    found = scenes.polygon_coverage(items, square(0.0))
    assert {r.scene_id: round(r.area, 9) for r in found.collect()} == {0: 1.0, 1: 0.6}
    assert "flatten" not in found._jdf.queryExecution().optimizedPlan().toString()
