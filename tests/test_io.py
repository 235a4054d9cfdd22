import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strandline.sources import readers, writers
from strandline.streaming import incremental


def write(path, obj):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(obj if isinstance(obj, str) else json.dumps(obj))
    return str(path)


def feature(kind, coordinates, **props):
    return {"type": "Feature", "properties": props, "geometry": {"type": kind, "coordinates": coordinates}}


SQUARE = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]


def test_regions(spark, tmp_path):
    path = write(tmp_path / "r.geojson", {"type": "FeatureCollection", "features": [feature("Polygon", SQUARE, type="roi", id="1"), feature("Polygon", SQUARE, type="roi", id="2"), feature("Polygon", SQUARE, type="other", id="1")]})
    assert readers.features(spark, path).count() == 2
    assert readers.features(spark, path, "2").count() == 1
    plain = write(tmp_path / "p.geojson", {"type": "FeatureCollection", "features": [feature("Polygon", SQUARE, id="7"), feature("MultiPolygon", [SQUARE, SQUARE])]})
    f = readers.features(spark, plain, "no such id")
    assert f.count() == 2
    rings = readers.polygon_rings(f).collect()
    assert len(rings) == 3 and len(rings[0].ring) == 5 and rings[0].ring[1].x == 2


def test_lines_and_points(spark, tmp_path):
    path = write(tmp_path / "t.geojson", {"type": "FeatureCollection", "features": [feature("LineString", [[0, 0], [1, 1]], id="a"), feature("MultiLineString", [[[0, 0, 5], [1, 1, 6]], [[2, 2], [3, 3]]]), feature("MultiPoint", [[9, 9], [8, 8]])]})
    f = readers.features(spark, path)
    v = readers.line_vertices(f).orderBy("feature", "part", "seq").collect()
    assert [(r.feature, r.part, r.x, r.z) for r in v] == [(0, 0, 0, 0), (0, 0, 1, 0), (1, 0, 0, 5), (1, 0, 1, 6), (1, 1, 2, 0), (1, 1, 3, 0)]
    assert {r.transect_id for r in readers.transect_vertices(f).collect()} == {"a", "1"}
    assert readers.point_vertices(f).count() == 2


def test_scene_metadata(spark, tmp_path):
    path = write(tmp_path / "m.json", {"id": "s1", "type": "Feature", "geometry": {"type": "Polygon", "coordinates": SQUARE}, "properties": {"acquired": "2023-06-16T15:30:32.931648Z", "cloud_cover": 0.25, "satellite_id": "2479", "instrument": "PSB.SD"}})
    r = readers.scene_metadata(spark, path).first()
    assert (r.scene_id, r.cloud_cover, r.acquired.date(), r.maxx) == ("s1", 0.25, dt.date(2023, 6, 16), 2)
    assert "properties" in readers.scene_metadata(spark, path, flat=False).columns


def test_reflectance_coefficients(spark, tmp_path):
    band = "<ps:bandSpecificMetadata><ps:bandNumber>{0}</ps:bandNumber><ps:reflectanceCoefficient>{0}.5e-05</ps:reflectanceCoefficient></ps:bandSpecificMetadata>"
    xml = f"""<?xml version="1.0"?><ps:EarthObservation xmlns:ps="p" xmlns:gml="g" xmlns:eop="e"><gml:using><eop:EarthObservationEquipment>
    <eop:instrument><eop:Instrument><eop:shortName>PS2</eop:shortName></eop:Instrument></eop:instrument></eop:EarthObservationEquipment></gml:using>
    <gml:resultOf><ps:EarthObservationResult>{''.join(band.format(i) for i in (1, 2, 3, 4))}</ps:EarthObservationResult></gml:resultOf></ps:EarthObservation>"""
    got = readers.reflectance_coefficients(spark, write(tmp_path / "a.xml", xml)).orderBy("band").collect()
    assert [(r.band, r.coeff, r.instrument) for r in got] == [(i, pytest.approx(i * 1e-5 + 0.5e-5), "PS2") for i in (1, 2, 3, 4)]


def test_accuracy_and_model_card(spark, tmp_path):
    write(tmp_path / "m" / "a.txt", "x 1\nacc_georef 5.25\nacc_georef 9\n")
    write(tmp_path / "m" / "b.txt", "x 1\n")
    got = {r.path[-5]: r.acc_georef for r in readers.georef_accuracy(spark, str(tmp_path / "m")).collect()}
    assert got == {"a": 5.25, "b": 12.0}
    card = write(tmp_path / "card.json", {"CLASSES": {"0": "water", "1": "whitewater"}})
    assert {r.class_idx: r.class_name for r in readers.model_classes(spark, card).collect()} == {0: "water", 1: "whitewater"}


def test_catalogue_and_sidecars(spark, tmp_path):
    for n in ("o1/S/a_1_3B_x.tif", "o1/S/a_1_3B_udm.tif", "o2/S/b_1_3B_x.tif", "o2/S/b.xml"):
        write(tmp_path / n, "x")
    files = readers.catalogue(spark, str(tmp_path))
    assert files.count() == 4 and readers.catalogue(spark, str(tmp_path), "*.xml").count() == 1
    assert readers.matching_files(files, ["*.tif", "*_x.tif"]).count() == 5
    assert readers.file_by_regex(files, "B\\.XML").first().path.endswith("b.xml")
    with pytest.raises(Exception, match="no file matches"):
        readers.file_by_regex(files, "nothing").collect()
    folder = F.regexp_replace("path", "/[^/]*$", "")
    scenes = files.where(F.col("name").endswith("_x.tif")).select(folder.alias("folder"), F.split_part("name", F.lit("_3B"), F.lit(1)).alias("base"))
    got = {r.base: r.sidecar for r in readers.with_sidecar(scenes, files, "udm.tif").collect()}
    assert got["a_1"].endswith("udm.tif") and got["b_1"] is None
    assert readers.with_sidecar(scenes, files, "udm.tif", required=True).count() == 1


def series(spark):
    rows = [(dt.datetime(2024, 1, d), 1.0, 2.0, t, float(d), 3.0, 4.0) for d in (2, 1) for t in ("t1", "t2")]
    return spark.createDataFrame(rows, "dates timestamp, x double, y double, transect_id string, cross_distance double, shore_x double, shore_y double")


def test_sinks(spark, tmp_path):
    s = series(spark)
    writers.write_long_csv(s, str(tmp_path / "long"))
    assert spark.read.csv(str(tmp_path / "long"), header=True).columns == writers.SERIES
    writers.write_wide_csv(s.withColumnRenamed("dates", "date"), str(tmp_path / "wide"))
    assert spark.read.csv(str(tmp_path / "wide"), header=True).columns == ["dates", "t1", "t2"]
    writers.write_distances_json(s, str(tmp_path / "json"))
    got = {r.transect_id: (r.dates, r.cross_distance) for r in spark.read.json(str(tmp_path / "json")).collect()}
    assert got["t1"] == (["2024-01-01T00:00:00", "2024-01-02T00:00:00"], [1.0, 2.0])
    writers.write_geojson(writers.point_features(s), str(tmp_path / "pts"))
    one = json.loads(spark.read.text(str(tmp_path / "pts")).first().value)
    assert one["geometry"] == {"type": "Point", "coordinates": [3.0, 4.0]}
    v = spark.createDataFrame([(dt.datetime(2024, 1, 1), 0, 1, 1.0, 1.0), (dt.datetime(2024, 1, 1), 0, 0, 0.0, 0.0)], "date timestamp, line int, seq int, x double, y double")
    assert json.loads(writers.line_features(v).first().value)["geometry"]["coordinates"] == [[0.0, 0.0], [1.0, 1.0]]
    writers.write_dropped_csv(s, str(tmp_path / "drop"))
    im = spark.createDataFrame([("d/a_b_c_d_x.tif", "good"), ("d/e_b_c_d_x.tif", None)], "im_paths string, im_classes string")
    writers.write_by_verdict(im, str(tmp_path / "sorted"))
    assert {r.verdict for r in spark.read.parquet(str(tmp_path / "sorted")).collect()} == {"good", "bad"}
    files = spark.createDataFrame([("d/a_b_c_d_udm.tif", "a_b_c_d_udm.tif")], "path string, name string")
    assert writers.sidecars_by_verdict(im, files).first().verdict == "good"


def test_shoreline_json(spark, tmp_path):
    path = write(tmp_path / "s.json", {"dates": ["2024-01-01T00:00:00", "2024-01-02T00:00:00"], "shorelines": [[[1.0, 2.0], [3.0, 4.0]], []]})
    got = readers.shorelines_json(spark, path).orderBy("date", "seq").collect()
    assert [(r.x, r.y) for r in got] == [(1, 2), (3, 4), (None, None)]


def test_tiles(spark):
    p = spark.createDataFrame([(0, 300, 10)], "scene_id int, row int, col int")
    assert (r := readers.tiles(p).first()).tile_row == 1 and r.tile_col == 0


def test_order_states(spark):
    e = spark.createDataFrame([(1, "running", 1), (1, "success", 2), (2, "queued", 1)], "order_id int, state string, changed int")
    assert {r.order_id: (r.state, r.done) for r in incremental.order_states(e).collect()} == {1: ("success", True), 2: ("queued", False)}


def test_verdicts_resume(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "im_paths string, logit double"
    for rows in ([("a", 2.0), ("b", -1.0)], [("b", 5.0), ("c", 1.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        incremental.resumed_verdicts(spark, src, schema, out, ck).awaitTermination()
    assert {r.im_paths: r.im_classes for r in spark.read.parquet(out).collect()} == {"a": "good", "b": "bad", "c": "good"}


def test_series_as_scenes_arrive_is_the_batch_result(spark, tmp_path):
    from strandline.operators.transects import cross_distance
    from tests.test_transects import frames

    points, lines, _, _ = frames(spark)
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "date date, x double, y double"
    for k in (0, 1):
        points.where(F.pmod(F.floor("x"), F.lit(2)) == k).coalesce(1).write.mode("append").parquet(src)
        incremental.series_as_scenes_arrive(spark, src, schema, lines, out, ck, mode="max").awaitTermination()
    got = {(r.transect_id, r.date): r.cross_distance for r in spark.read.parquet(out).collect()}
    assert got == {(r.transect_id, r.date): r.cross_distance for r in cross_distance(points, lines, "max").collect()}


def test_wide_csv_of_more_transects_than_a_pivot(spark, tmp_path):
    spark.conf.set("spark.sql.pivotMaxValues", "100")
    ids = F.when(F.col("id") == 8, 'a "b", c').otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 2)))
    s = spark.range(5000).select(F.expr("timestamp'2024-01-01 10:00:00' + make_dt_interval(cast(id % 7 as int))").alias("dates"), ids.alias("transect_id"), (F.col("id") / 3).alias("cross_distance"))
    writers.write_wide_csv(s, str(tmp_path / "wide"))
    got = readers.wide_csv(spark, str(tmp_path / "wide")).select(F.col("dates").cast("timestamp"), "transect_id", "cross_distance")
    spark.conf.unset("spark.sql.pivotMaxValues")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, s.collect()))
    heads = [r.value for r in spark.read.text(str(tmp_path / "wide")).where("value like 'dates,%'").collect()]
    assert len(heads) == 3 and sum('"a ""b"", c"' in h for h in heads) == 1
