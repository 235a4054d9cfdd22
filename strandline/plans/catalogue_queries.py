"""Registered queries of the catalogue, the names and the sources and sinks: files are written and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.functions import names
from strandline.functions.staging import checkpoint_dir
from strandline.operators import contours, quality, radiometry, scenes, transects
from strandline.plans import queries as shore
from strandline.plans.queries import query, rounded
from strandline.plans.views import view
from strandline.sources import readers, writers
from strandline.streaming import incremental


def _new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _one_file_each(texts: DataFrame, path: str) -> None:
    """``value`` as text files, one for each ``bucket``, lines in order of ``line`` where there is one."""
    order = ["bucket"] + (["line"] if "line" in texts.columns else [])
    texts.repartition("bucket").sortWithinPartitions(*order).select("bucket", "value").write.partitionBy("bucket").text(path)


# --- catalogue -----------------------------------------------------------------------------------------

_BETWEEN = "minx <= 0.75 AND 0.25 <= maxx AND miny <= 0.75 AND 0.25 <= maxy AND acquired > TIMESTAMP '2020-01-01 00:00:00' AND acquired < TIMESTAMP '2030-01-01 00:00:00' AND cloud_cover <= 0.6"


@query(f"SELECT scene_id, cloud_cover FROM scene_item WHERE {_BETWEEN} ORDER BY acquired, scene_id LIMIT 500", "scene_item")
def scene_search_limited(spark, sf_dir):
    # the limit is the feature: a search returns the first so many
    found = scenes.search(view(spark, sf_dir, "scene_item"), shore.REGION, dt.datetime(2020, 1, 1), dt.datetime(2030, 1, 1), 0.6, limit=500)
    return found.select("scene_id", "cloud_cover")


#: A region that is not convex, with a hole: outer ring, then holes.
_NOTCHED = [[(0.2, 0.2), (0.81, 0.23), (0.78, 0.83), (0.5, 0.41), (0.22, 0.79)], [(0.3, 0.3), (0.4, 0.31), (0.36, 0.4)]]


def _coverage_sql(rings: list) -> str:
    """Areas by Green's theorem: each edge's integral of y, held between the box's lower and upper side."""
    edges, total = [], 0.0
    for number, ring in enumerate(rings):
        turn = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
        ring = ring if (turn > 0) == (number == 0) else ring[::-1]
        total += abs(turn) / 2 * (1 if number == 0 else -1)
        edges += [(*b, *a) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    values = ", ".join(f"({', '.join(f'CAST({v} AS DOUBLE)' for v in e)})" for e in edges)
    up = "CASE WHEN {0} <= miny THEN 0 WHEN {0} < maxy THEN ({0} - miny) * ({0} - miny) / 2 ELSE (maxy - miny) * (maxy - miny) / 2 + (maxy - miny) * ({0} - maxy) END"
    return f""", e(ax, ay, zx, zy) AS (VALUES {values}),
c AS (SELECT *, greatest(least(ax, maxx), minx) AS u, greatest(least(zx, maxx), minx) AS v FROM scene_item, e WHERE ax <> zx),
s AS (SELECT *, ay + (u - ax) * (zy - ay) / (zx - ax) AS yu, ay + (v - ax) * (zy - ay) / (zx - ax) AS yv FROM c),
a AS (SELECT scene_id, sum(CASE WHEN zy = ay THEN (greatest(least(ay, maxy), miny) - miny) * (v - u) ELSE ({up.format("yv")} - ({up.format("yu")})) * (zx - ax) / (zy - ay) END) AS area FROM s GROUP BY scene_id)
SELECT scene_id, round(area + 1.3e-8, 6) AS area FROM a WHERE area > 0.5 * {total!r}"""


def _coverage(spark, sf_dir, region):
    p = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
    ring = F.array(p("minx", "miny"), p("maxx", "miny"), p("maxx", "maxy"), p("minx", "maxy"))
    items = view(spark, sf_dir, "scene_item").withColumn("ring", ring)
    # both sides step off rounding ties
    return scenes.polygon_coverage(items, region).select("scene_id", F.round(F.col("area") + 1.3e-8, 6).alias("area"))


_CONVEX = [(0.25, 0.25), (0.75, 0.3), (0.7, 0.75), (0.3, 0.7)]


@query(_coverage_sql([_CONVEX]), "scene_item")
def scene_polygon_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir, _CONVEX)


@query(_coverage_sql(_NOTCHED), "scene_item")
def scene_region_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir, _NOTCHED)


#: Corners of a part about its centre in units of (a, b) and plain ones, and of the hole that some have.
_KITE = [(-1, 0, 0, 0), (0, -1, 0, 0), (1, 0, 0, 0.02), (0, 1, -0.01, 0)]
_HOLE = [(0, 0, -0.01, -0.01), (0, 0, 0.01, -0.01), (0, 0, 0.01, 0.01), (0, 0, -0.01, 0.01)]


def _corner_values() -> str:
    rows = [(ring, *p, *q) for ring, points in enumerate((_KITE, _HOLE)) for p, q in zip(points, points[1:] + points[:1], strict=True)]
    return ", ".join(f"({', '.join(f'CAST({v} AS DOUBLE)' for v in r)})" for r in rows)


#: The union's height along the middle of each stretch of x without a break, times the stretch: breaks are corners,
#: crossings of edges and of the box's sides; a part covers what lies between its first and second edge, and so on.
_REGIONS_SQL = f""", box AS (SELECT DISTINCT minx, miny, maxx, maxy FROM scene_item),
k(ring, fa, fb, fx, fy, ta, tb, tx, ty) AS (VALUES {_corner_values()}),
side AS (SELECT part, ring, cx + fa * a + fx AS px, cy + fb * b + fy AS py, cx + ta * a + tx AS qx, cy + tb * b + ty AS qy FROM region_part, k WHERE ring = 0 OR holed),
total AS (SELECT sum(CASE WHEN ring = 0 THEN area ELSE -area END) AS total FROM (SELECT part, ring, abs(sum(px * qy - qx * py)) / 2 AS area FROM side GROUP BY part, ring)),
e AS (SELECT row_number() OVER () AS i, part, px, py, qx, qy, (qy - py) / (qx - px) AS m FROM (SELECT part, CASE WHEN px < qx THEN px ELSE qx END AS px, CASE WHEN px < qx THEN py ELSE qy END AS py, CASE WHEN px < qx THEN qx ELSE px END AS qx, CASE WHEN px < qx THEN qy ELSE py END AS qy FROM side WHERE px <> qx)),
cross_x AS (SELECT ((f.py - f.m * f.px) - (e.py - e.m * e.px)) / (e.m - f.m) AS x FROM e JOIN e f ON e.i < f.i AND e.m <> f.m AND e.px < f.qx AND f.px < e.qx),
anywhere AS (SELECT px AS x FROM e UNION SELECT qx FROM e UNION SELECT x FROM cross_x),
breaks AS (SELECT minx, miny, maxx, maxy, x FROM box, anywhere WHERE x > minx AND x < maxx UNION SELECT *, minx FROM box UNION SELECT *, maxx FROM box
 UNION SELECT minx, miny, maxx, maxy, px + (y - py) / m FROM (SELECT *, miny AS y FROM box UNION SELECT *, maxy FROM box), e WHERE m <> 0 AND px + (y - py) / m > greatest(minx, px) AND px + (y - py) / m < least(maxx, qx)),
slab AS (SELECT *, lead(x) OVER (PARTITION BY minx, miny, maxx, maxy ORDER BY x) AS z FROM breaks),
hit AS (SELECT slab.*, part, py + ((x + z) / 2 - px) * m AS y FROM slab JOIN e ON px <= x AND qx >= z WHERE z > x),
turn AS (SELECT *, row_number() OVER (PARTITION BY minx, miny, maxx, maxy, x, part ORDER BY y) AS n, lead(y) OVER (PARTITION BY minx, miny, maxx, maxy, x, part ORDER BY y) AS up FROM hit),
piece AS (SELECT minx, miny, maxx, maxy, x, z, greatest(miny, y) AS lo, least(maxy, up) AS hi FROM turn WHERE n % 2 = 1 AND up > miny AND y < maxy),
run AS (SELECT *, coalesce(max(hi) OVER (PARTITION BY minx, miny, maxx, maxy, x ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo) AS reached FROM piece),
cover AS (SELECT minx, miny, maxx, maxy, sum((z - x) * greatest(0, hi - greatest(lo, reached))) AS area FROM run GROUP BY minx, miny, maxx, maxy)
SELECT scene_id, round(area + 1.3e-8, 6) AS area FROM scene_item JOIN cover USING (minx, miny, maxx, maxy), total WHERE area > 0.1 * total"""


def _regions(spark, sf_dir):
    """Regions of ten and more parts that overlap, some with holes, as rings."""
    corner = lambda k: F.struct((F.col("cx") + k[0] * F.col("a") + k[2]).alias("x"), (F.col("cy") + k[1] * F.col("b") + k[3]).alias("y"))
    kite, hole = (F.array(*[corner(k) for k in points]) for points in (_KITE, _HOLE))
    rings = F.when(F.col("holed"), F.array(kite, hole)).otherwise(F.array(kite))
    return view(spark, sf_dir, "region_part").select("region_id", "part", F.explode(rings).alias("ring"))


@query(_REGIONS_SQL, "scene_item", "region_part")
def scene_regions_coverage(spark, sf_dir):
    p = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
    ring = F.array(p("minx", "miny"), p("maxx", "miny"), p("maxx", "maxy"), p("minx", "maxy"))
    items = view(spark, sf_dir, "scene_item").withColumn("ring", ring)
    found = scenes.regions_coverage(items, _regions(spark, sf_dir), share=0.1)
    return found.select("scene_id", F.round(F.col("area") + 1.3e-8, 6).alias("area"))


@query("SELECT file_id, coalesce((east - west) * (north - south) >= 9e6, false) AS good, round((east - west) * (north - south) / 1e6, 6) AS km2 FROM raster_file", "raster_file")
def files_by_area(spark, sf_dir):
    f = view(spark, sf_dir, "raster_file").withColumnsRenamed({"west": "left", "east": "right", "south": "bottom", "north": "top"})
    good, bad = scenes.big_enough(f, 10.0)
    both = good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))
    km2 = geo.square_km((F.col("right") - F.col("left")) * (F.col("top") - F.col("bottom")))
    return both.select("file_id", "good", F.round(km2, 6).alias("km2"))


def _broken(condition: str, rule: str) -> str:
    return f"CASE WHEN NOT coalesce({condition}, false) THEN '{rule}' END"


@query(
    "SELECT order_id, concat_ws('; ', "
    + ", ".join(
        [
            _broken("try_cast(start_date AS DATE) IS NOT NULL", "start_date is no date"),
            _broken("try_cast(end_date AS DATE) IS NOT NULL", "end_date is no date"),
            _broken("try_cast(start_date AS DATE) < try_cast(end_date AS DATE)", "start_date is not before end_date"),
            _broken("cloud_cover BETWEEN 0 AND 1", "cloud_cover is not in [0, 1]"),
            _broken("min_area_percentage BETWEEN 0 AND 1", "min_area_percentage is not in [0, 1]"),
            _broken("roi_path LIKE '%.geojson'", "roi_path is no .geojson"),
        ]
    )
    + ") AS violations FROM order_spec",
    "order_spec",
)
def order_violations(spark, sf_dir):
    return scenes.violations(view(spark, sf_dir, "order_spec")).select("order_id", F.array_join("violations", "; ").alias("violations"))


@query(
    "SELECT 'off' AS setting, '' AS scene_id UNION ALL SELECT 'own', CAST(max(scene_id) AS STRING) FROM scene_item"
    " UNION ALL SELECT 'least cloud', CAST(arg_min(scene_id, (cloud_cover, seq)) AS STRING) FROM scene_item",
    "scene_item",
)
def coregister_reference(spark, sf_dir):
    items = view(spark, sf_dir, "scene_item")
    own = str(items.agg(F.max("scene_id")).first()[0])
    settings = [("off", False, None), ("own", True, own), ("least cloud", True, None)]
    off, user, least = [scenes.coregister_choice(items, wanted, chosen).select(F.lit(k).alias("setting"), "scene_id") for k, wanted, chosen in settings]
    return off.unionByName(user).unionByName(least)


@query("SELECT max(sensor) AS sensor FROM (SELECT sensor FROM landsat_file WHERE sensor <> 'L6' GROUP BY sensor HAVING count(DISTINCT kind) = 3)", "landsat_file")
def landsat_sensor(spark, sf_dir):
    return scenes.best_sensor(view(spark, sf_dir, "landsat_file"))


_INSIDE = "path LIKE '%/PSScene/%' AND lower(path) LIKE "


@query(
    f"SELECT order_id, bool_or({_INSIDE} '%.tif') AND bool_or({_INSIDE} '%.xml') AND bool_or({_INSIDE} '%.json') AS complete FROM order_file GROUP BY order_id",
    "order_file",
)
def order_completeness(spark, sf_dir):
    return scenes.complete_orders(view(spark, sf_dir, "order_file"), "PSScene")


def _rings(spark, sf_dir):
    p = lambda x, y: F.struct(F.lit(0.0) + x, F.lit(0.0) + y)
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((F.lit(0.0), F.lit(0.0)), (F.col("w"), F.lit(0.0)), (F.col("w"), F.col("h")), (F.lit(0.0), F.col("h") / 2))])
    return view(spark, sf_dir, "region_side").select("region_id", ring.alias("ring"))


@query("SELECT region_id, round(abs(w * 0.75 * h), 4) AS area FROM region_side", "region_side")
def region_areas(spark, sf_dir):
    return _rings(spark, sf_dir).select("region_id", F.round(geo.ring_area("ring"), 4).alias("area"))


@query("SELECT round(sum(abs(w * 0.75 * h)), 3) AS area_m2, round(sum(abs(w * 0.75 * h)) / 1e6, 6) AS area_km2 FROM region_side", "region_side")
def total_region_area(spark, sf_dir):
    return rounded(scenes.total_area(_rings(spark, sf_dir)).withColumn("area_m2", F.col("area_m2")), 3, "area_m2").withColumn("area_km2", F.round("area_km2", 6))


# --- names and texts -----------------------------------------------------------------------------------


def _files(spark, sf_dir):
    f = view(spark, sf_dir, "scene_file").withColumn("name", F.concat("base", "ending"))
    return f.withColumn("path", F.concat_ws("/", "folder", "name"))


@query(
    "SELECT file_id, base AS scene_id, concat('2024-01-0', substr(base, 8, 1), '-', substr(base, 10, 2), '-30-15') AS taken, substr(base, 1, 8) AS token,"
    " concat('2024-01-0', substr(base, 8, 1)) AS day, concat(base, ending) AS name FROM scene_file",
    "scene_file",
)
def file_name_parts(spark, sf_dir):
    f, name = _files(spark, sf_dir), names.file_name("path")
    iso = F.date_format(names.name_time(name), "yyyy-MM-dd'T'HH:mm:ss")
    return f.select("file_id", names.scene_id(name).alias("scene_id"), names.name_date(name).alias("taken"), names.first_token(name).alias("token"), names.acquired_date(iso).alias("day"), name.alias("name"))


@query(
    "SELECT order_id, lower(trim(tool)) AS known, lower(other) AS unknown FROM order_tool",
    "order_tool",
)
def order_tools(spark, sf_dir):
    t = view(spark, sf_dir, "order_tool")
    known, unknown = names.known_tools(F.array("tool", "other"))
    return t.select("order_id", F.array_join(known, ",").alias("known"), F.array_join(unknown, ",").alias("unknown"))


@query("SELECT scene_id, CASE WHEN scene_id % 3 = 0 THEN NULL ELSE concat('EPSG:', CAST(32617 + scene_id % 2 AS STRING)) END AS epsg FROM scene_item", "scene_item")
def projected_systems(spark, sf_dir):
    code = F.when(F.col("scene_id") % 3 == 0, 4326).otherwise(32617 + F.col("scene_id") % 2)
    return view(spark, sf_dir, "scene_item").select("scene_id", names.projected_epsg(code).alias("epsg"))


@query(
    "SELECT scene_id, strftime(acquired, '%Y-%m-%d %H:%M:%S') AS acquired, round(1 / (1 + exp(-(cloud_cover * 20 - 4))), 6) AS im_scores FROM scene_item WHERE cloud_cover * 20 - 4 > 0",
    "scene_item",
)
def good_scenes_as_text(spark, sf_dir):
    s = view(spark, sf_dir, "scene_item").select("scene_id", "acquired", (F.col("cloud_cover") * 20 - 4).alias("logit"))
    kept = names.timestamps_as_text(quality.good(quality.verdicts(s)))
    return rounded(kept.select("scene_id", "acquired", "im_scores"), 6, "im_scores")


_PATTERNS = {"*_3B_x.*": "%\\_3B\\_x.%", "2024010?_0*.tif": "2024010_\\_0%.tif"}


@query(
    " UNION ALL ".join(f"SELECT file_id, '{g}' AS pattern FROM scene_file WHERE concat(base, ending) LIKE '{like}' ESCAPE '\\'" for g, like in _PATTERNS.items()),
    "scene_file",
)
def files_by_pattern(spark, sf_dir):
    return readers.matching_files(_files(spark, sf_dir), list(_PATTERNS)).select("file_id", "pattern")


@query("SELECT min(concat(folder, '/', base, ending)) AS path FROM scene_file WHERE ending = '_3B_x.xml'", "scene_file")
def file_by_regex(spark, sf_dir):
    return readers.file_by_regex(_files(spark, sf_dir), r"_3b_X\.XML$")


_SIDE = "SELECT s.file_id, min(f.folder || '/' || f.base || f.ending) AS sidecar FROM scene_file s {} JOIN scene_file f ON f.folder = s.folder AND f.base = s.base AND f.ending = '_3B_x.tif' GROUP BY s.file_id"


@query(_SIDE.format("LEFT"), "scene_file")
def scene_sidecars(spark, sf_dir):
    f = _files(spark, sf_dir)
    return readers.with_sidecar(f.select("file_id", "folder", "base"), f, "_3B_x.tif").select("file_id", "sidecar")


@query(_SIDE.format(""), "scene_file")
def scenes_with_sidecar(spark, sf_dir):
    f = _files(spark, sf_dir)
    return readers.with_sidecar(f.select("file_id", "folder", "base"), f, "_3B_x.tif", required=True).select("file_id", "sidecar")


# --- pixels and lines ----------------------------------------------------------------------------------


@query("SELECT scene_id, row, col, band, dn FROM band_pixel WHERE band IN (1, 4)", "band_pixel")
def band_selection(spark, sf_dir):
    return radiometry.bands(view(spark, sf_dir, "band_pixel"), [1, 4]).select("scene_id", "row", "col", "band", "dn")


@query(
    "SELECT scene_id, row, col, class_idx, CASE WHEN row % 16 = 0 THEN 0 WHEN trunc(score * 10000) BETWEEN 0 AND 65535 THEN CAST(trunc(score * 10000) AS INT) END AS scaled FROM class_score",
    "class_score",
)
def scaled_reflectance(spark, sf_dir):
    v = F.when(F.col("row") % 16 == 0, float("inf")).otherwise(F.col("score"))
    return view(spark, sf_dir, "class_score").select("scene_id", "row", "col", "class_idx", radiometry.scaled_float(v).alias("scaled"))


_CLEAN = """, k AS (SELECT * FROM contour_vertex QUALIFY max(CASE WHEN isnan(x) AND isnan(y) THEN 1 ELSE 0 END) OVER (PARTITION BY contour) = 0),
v AS (SELECT * FROM k WHERE NOT isnan(x) AND NOT isnan(y) QUALIFY count(*) OVER (PARTITION BY contour) > 1) """


@query(_CLEAN + "SELECT contour, seq, round(x, 6) AS x, round(y, 6) AS y FROM v", "contour_vertex")
def contour_cleanup(spark, sf_dir):
    return rounded(contours.clean(view(spark, sf_dir, "contour_vertex"), ["contour"]), 6, "x", "y")


@query(
    _CLEAN + ", d AS (SELECT *, sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2)) AS step FROM v WINDOW w AS (PARTITION BY contour ORDER BY seq))"
    " SELECT contour, seq, round(x, 6) AS x, round(y, 6) AS y FROM d QUALIFY sum(step) OVER (PARTITION BY contour) >= 1000",
    "contour_vertex",
)
def contours_long_enough(spark, sf_dir):
    v = contours.clean(view(spark, sf_dir, "contour_vertex"), ["contour"])
    return rounded(contours.long_enough(v, 1000, ["contour"]).select("contour", "seq", "x", "y"), 6, "x", "y")


@query("SELECT o_custkey AS contour, CASE WHEN count(*) >= 2 THEN count(*) END AS n_line, count(*) AS n_point FROM orders WHERE o_orderkey % 7 = 0 OR o_custkey % 2 = 0 GROUP BY o_custkey")
def line_geometries(spark, sf_dir):
    # an order's place in its customer's contour; of odd customers every seventh order is a vertex
    v = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderkey % 7 = 0 OR o_custkey % 2 = 0")
    at = F.struct(F.col("o_totalprice").alias("x"), F.col("o_orderkey").cast("double").alias("y"))
    pts = v.groupBy(F.col("o_custkey").alias("contour")).agg(F.array_sort(F.collect_list(at)).alias("points"))
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c).cast("long"))
    lines = transects.geometry(pts, "lines").withColumnRenamed("geometry", "line")
    return transects.geometry(lines, "points").select("contour", size("line").alias("n_line"), size("geometry").alias("n_point"))


_PARTS = ", p AS (SELECT s_suppkey, part, seq, CAST(100 * s_suppkey + 10 * part + seq * seq AS DOUBLE) AS x, CAST(50 * seq AS DOUBLE) AS y FROM supplier, range(0, 3) a(part), range(0, 4) b(seq) WHERE part <= s_suppkey % 3)"


def _parts(spark, sf_dir):
    """Transects of one to three parts with four vertices each."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    v = s.select("s_suppkey", F.explode(F.sequence(F.lit(0), (F.col("s_suppkey") % 3).cast("int"))).alias("part"))
    v = v.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("seq"))
    x = (100 * F.col("s_suppkey") + 10 * F.col("part") + F.col("seq") * F.col("seq")).cast("double")
    return v.select("s_suppkey", "part", "seq", x.alias("x"), (50 * F.col("seq")).cast("double").alias("y"))


@query(
    "WITH t AS (SELECT 1)" + _PARTS + ", l AS (SELECT * FROM p WHERE part = s_suppkey % 3) SELECT concat('t', CAST(s_suppkey AS STRING)) AS transect_id,"
    " arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS x1, arg_max(y, seq) AS y1 FROM l GROUP BY s_suppkey",
)
def transect_ends(spark, sf_dir):
    v = _parts(spark, sf_dir).withColumn("transect_id", F.concat(F.lit("t"), F.col("s_suppkey").cast("string")))
    return transects.end_points(v).select("transect_id", "x0", "y0", "x1", "y1")


# --- sources and sinks ---------------------------------------------------------------------------------


@query(
    "WITH t AS (SELECT 1)" + _PARTS + " SELECT CAST(s_suppkey AS STRING) AS transect_id, CAST(part AS INT) AS part, CAST(seq AS INT) AS seq, x, y, CAST(0 AS DOUBLE) AS z FROM p WHERE s_suppkey % 5 <> 0",
)
def feature_source(spark, sf_dir):
    # GeoJSON collections of 100 transects each; every fifth feature is of another type than roi
    line = F.array_sort(F.collect_list(F.struct("seq", "x", "y")))
    lines = _parts(spark, sf_dir).groupBy("s_suppkey", "part").agg(F.transform(line, lambda p: F.array(p.x, p.y)).alias("l"))
    f = lines.groupBy("s_suppkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "l"))), lambda p: p.l).alias("m"))
    kind = F.when(F.size("m") > 1, "MultiLineString").otherwise("LineString")
    coordinates = F.when(F.size("m") > 1, F.to_json("m")).otherwise(F.to_json(F.col("m")[0]))
    role = F.when(F.col("s_suppkey") % 5 == 0, "note").otherwise("roi")
    text = F.format_string('{"type":"Feature","properties":{"id":"%d","type":"%s"},"geometry":{"type":"%s","coordinates":%s}}', "s_suppkey", role, kind, coordinates)
    bucket = F.floor(F.col("s_suppkey") / 100).alias("bucket")
    all_ = f.groupBy(bucket).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(text), ","), F.lit("]}")).alias("value"))
    path = _new_folder(spark, "features")
    _one_file_each(all_, path)
    v = readers.line_vertices(readers.features(spark, path))
    return v.select(F.col("properties")["id"].alias("transect_id"), "part", "seq", "x", "y", "z")


@query("SELECT CAST(scene_id AS STRING) AS scene_id, cloud_cover, instrument, minx, miny, maxx, maxy FROM scene_item", "scene_item")
def scene_metadata_source(spark, sf_dir):
    s = view(spark, sf_dir, "scene_item")
    corner = lambda a, b: F.array(F.col(a), F.col(b))
    ring = F.array(corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy"))
    properties = F.struct("cloud_cover", "instrument", F.col("satellite_id").cast("string").alias("satellite_id"))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    text = F.to_json(F.struct(F.col("scene_id").cast("string").alias("id"), F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")))
    lists = s.groupBy(F.floor(F.col("scene_id") / 500).alias("bucket")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(text), ","), F.lit("]")).alias("value"))
    path = _new_folder(spark, "scenes")
    _one_file_each(lists, path)
    return readers.scene_metadata(spark, path).select("scene_id", "cloud_cover", "instrument", "minx", "miny", "maxx", "maxy")


@query("SELECT s_name AS instrument, CAST(b AS INT) AS band, CAST(s_suppkey * 8 + b AS DOUBLE) / 1024 AS coeff FROM supplier, range(1, 5) r(b)")
def coefficient_source(spark, sf_dir):
    # XML metadata of a scene for each supplier; the fifth band is one that the reader leaves out
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    at = lambda b: ((F.col("s_suppkey") * 8 + b).cast("double") / 1024).cast("string")
    band = lambda b: F.concat(F.lit(f"<ps:bandSpecificMetadata><ps:bandNumber>{b}</ps:bandNumber><ps:reflectanceCoefficient>"), at(b), F.lit("</ps:reflectanceCoefficient></ps:bandSpecificMetadata>"))
    name = "eop:EarthObservationEquipment><eop:instrument><eop:Instrument><eop:shortName"
    close = "eop:shortName></eop:Instrument></eop:instrument></eop:EarthObservationEquipment"
    head = F.concat(F.lit(f"<ps:EarthObservation><gml:using><{name}>"), F.col("s_name"), F.lit(f"</{close}></gml:using><gml:resultOf><ps:EarthObservationResult>"))
    tail = F.lit("</ps:EarthObservationResult></gml:resultOf></ps:EarthObservation>")
    record = F.concat(head, *[band(b) for b in range(1, 6)], tail)
    files = s.groupBy(F.floor(F.col("s_suppkey") / 100).alias("bucket")).agg(F.concat(F.lit("<all>"), F.array_join(F.collect_list(record), ""), F.lit("</all>")).alias("value"))
    path = _new_folder(spark, "metadata")
    _one_file_each(files, path)
    return readers.reflectance_coefficients(spark, path).select("instrument", "band", "coeff")


@query("SELECT s_nationkey AS nation, CASE WHEN s_nationkey % 4 = 0 THEN CAST(12 AS DOUBLE) ELSE arg_min(CAST(s_suppkey AS DOUBLE) / 8, s_suppkey) END AS acc_georef FROM supplier GROUP BY s_nationkey")
def accuracy_source(spark, sf_dir):
    # a key-value text for each nation; of every fourth one no line states an accuracy
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.when(F.col("s_nationkey") % 4 == 0, "note").otherwise("acc_georef")
    value = F.concat_ws(" ", key, (F.col("s_suppkey").cast("double") / 8).cast("string"))
    path = _new_folder(spark, "accuracy")
    _one_file_each(s.select(F.col("s_nationkey").alias("bucket"), F.col("s_suppkey").alias("line"), value.alias("value")), path)
    nation = F.regexp_extract("path", r"bucket=(\d+)", 1).cast("int")
    return readers.georef_accuracy(spark, path).select(nation.alias("nation"), "acc_georef")


@query("SELECT CAST(s_suppkey AS INT) AS class_idx, s_name AS class_name FROM supplier")
def class_map_source(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").groupBy(F.floor(F.col("s_suppkey") / 100).alias("bucket"))
    entries = F.map_from_entries(F.collect_list(F.struct(F.col("s_suppkey").cast("string"), "s_name")))
    path = _new_folder(spark, "cards")
    _one_file_each(s.agg(F.to_json(F.struct(entries.alias("CLASSES"))).alias("value")), path)
    return readers.model_classes(spark, path)


@query("SELECT DISTINCT s_nationkey AS nation FROM supplier")
def file_catalogue(spark, sf_dir):
    path = _new_folder(spark, "files")
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    _one_file_each(s.select(F.col("s_nationkey").alias("bucket"), F.col("s_name").alias("value")), path)
    found = readers.catalogue(spark, path, "*.txt")
    return found.where("length > 0").select(F.regexp_extract("path", r"bucket=(\d+)", 1).cast("int").alias("nation"))


@query(
    "SELECT o_custkey AS contour, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS seq, o_totalprice AS x, CAST(o_orderkey AS DOUBLE) AS y FROM orders",
)
def shoreline_source(spark, sf_dir):
    # a customer is a shoreline of its orders, dated 1970-01-01 plus its key; 100 shorelines a file
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    own = F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice")))
    pts = F.transform(own, lambda p: F.array(p.o_totalprice, p.o_orderkey.cast("double")))
    lines = o.groupBy("o_custkey").agg(pts.alias("p")).select("o_custkey", F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("o_custkey").cast("int")), "yyyy-MM-dd'T'HH:mm:ss").alias("d"), "p")
    docs = lines.groupBy(F.floor(F.col("o_custkey") / 100).alias("bucket")).agg(F.sort_array(F.collect_list(F.struct("o_custkey", "d", "p"))).alias("s"))
    value = F.to_json(F.struct(F.transform("s", lambda v: v.d).alias("dates"), F.transform("s", lambda v: v.p).alias("shorelines")))
    path = _new_folder(spark, "shorelines")
    _one_file_each(docs.select("bucket", value.alias("value")), path)
    got = readers.shorelines_json(spark, path)
    return got.select(F.datediff(F.col("date").cast("date"), F.lit("1970-01-01").cast("date")).cast("long").alias("contour"), "seq", "x", "y")


_SERIES_TYPES = "dates date, x double, y double, transect_id string, cross_distance double, shore_x double, shore_y double"


def _time_series(spark, sf_dir):
    return transects.time_series(view(spark, sf_dir, "shoreline_point"), view(spark, sf_dir, "transect"))


@query(shore.ORACLE_SQL["timeseries_merged"])
def long_csv_sink(spark, sf_dir):
    path = _new_folder(spark, "long")
    writers.write_long_csv(_time_series(spark, sf_dir), path)
    return rounded(spark.read.csv(path, schema=_SERIES_TYPES, header=True), 4, "cross_distance", "shore_x", "shore_y")


@query(shore.ORACLE_SQL["timeseries_wide_long"])
def wide_csv_sink(spark, sf_dir):
    path = _new_folder(spark, "wide")
    writers.write_wide_csv(shore._series(spark, sf_dir).withColumnRenamed("date", "dates"), path)
    return rounded(readers.wide_csv(spark, path).withColumn("dates", F.col("dates").cast("date")), 4, "cross_distance")


@query("SELECT dates, transect_id, cross_distance, shore_x, shore_y FROM (" + shore.ORACLE_SQL["timeseries_merged"] + ")")
def point_geojson_sink(spark, sf_dir):
    path = _new_folder(spark, "points")
    writers.write_geojson(writers.point_features(_time_series(spark, sf_dir)), path)
    kind = "type string, properties struct<dates:timestamp, transect_id:string, cross_distance:double>, geometry struct<type:string, coordinates:array<double>>"
    f = spark.read.schema(kind).json(path).where("geometry.type = 'Point'")
    out = f.select(F.col("properties.dates").cast("date").alias("dates"), "properties.transect_id", "properties.cross_distance", F.col("geometry.coordinates")[0].alias("shore_x"), F.col("geometry.coordinates")[1].alias("shore_y"))
    return rounded(out, 4, "cross_distance", "shore_x", "shore_y")


@query("WITH t AS (SELECT 1)" + _PARTS + " SELECT CAST(DATE '2020-01-01' + CAST(s_suppkey AS INT) AS DATE) AS date, CAST(seq AS INT) AS seq, x, y FROM p")
def line_geojson_sink(spark, sf_dir):
    v = _parts(spark, sf_dir)
    v = v.select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("s_suppkey").cast("int")).alias("date"), F.col("part").alias("line"), "seq", "x", "y")
    path = _new_folder(spark, "lines")
    writers.write_geojson(writers.line_features(v), path)
    kind = "type string, properties struct<date:timestamp>, geometry struct<type:string, coordinates:array<array<double>>>"
    f = spark.read.schema(kind).json(path).where("geometry.type = 'LineString'").select(F.col("properties.date").cast("date").alias("date"), F.posexplode("geometry.coordinates").alias("seq", "p"))
    return f.select("date", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


_GOOD = "CASE WHEN 1 / (1 + exp(-logit)) > 1 - 1 / (1 + exp(-logit)) THEN 'good' ELSE 'bad' END"


@query(f"SELECT im_paths, CASE WHEN already_scored THEN 'bad' ELSE {_GOOD} END AS verdict FROM classifier_logit", "classifier_logit")
def verdict_sink(spark, sf_dir):
    # images without a verdict go where the bad ones go
    v = quality.verdicts(view(spark, sf_dir, "classifier_logit")).withColumn("im_classes", F.when(~F.col("already_scored"), F.col("im_classes")))
    path = _new_folder(spark, "verdicts")
    writers.write_by_verdict(v, path)
    return spark.read.parquet(path).select("im_paths", "verdict")


@query(
    f"SELECT concat(folder, '/', base, ending) AS path, CASE WHEN max((event_id % 4 = 0)::INT * (value > 50)::INT) OVER (PARTITION BY base) = 1 THEN 'good' ELSE 'bad' END AS verdict FROM scene_file JOIN events ON event_id = file_id",
    "scene_file",
)
def sidecar_verdicts(spark, sf_dir):
    f = _files(spark, sf_dir)
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("file_id"), "value")
    images = f.join(e, "file_id").select(F.col("path").alias("im_paths"), F.when((F.col("file_id") % 4 == 0) & (F.col("value") > 50), "good").otherwise("bad").alias("im_classes"))
    return writers.sidecars_by_verdict(images, f)


# --- streams -------------------------------------------------------------------------------------------


@query(f"SELECT im_paths, {_GOOD} AS im_classes, round(greatest(1 / (1 + exp(-logit)), 1 - 1 / (1 + exp(-logit))), 6) AS im_scores FROM classifier_logit", "classifier_logit")
def streamed_verdicts(spark, sf_dir):
    path = _new_folder(spark, "scores")
    images = view(spark, sf_dir, "classifier_logit").select("im_paths", "logit")
    # every image arrives twice
    images.unionByName(images).repartition(8, "im_paths").write.parquet(f"{path}/in")
    incremental.resumed_verdicts(spark, f"{path}/in", "im_paths long, logit double", f"{path}/out", f"{path}/state", files=4).awaitTermination()
    return rounded(spark.read.parquet(f"{path}/out"), 6, "im_scores")


@query(shore.ORACLE_SQL["transect_cross_distance_nan"])
def streamed_series(spark, sf_dir):
    path = _new_folder(spark, "arrivals")
    view(spark, sf_dir, "shoreline_point").repartitionByRange(6, "date").write.parquet(f"{path}/in")
    incremental.series_as_scenes_arrive(spark, f"{path}/in", "date date, x double, y double", view(spark, sf_dir, "transect"), f"{path}/out", f"{path}/state", mode="nan").awaitTermination()
    return rounded(spark.read.parquet(f"{path}/out").select("transect_id", "date", "cross_distance"), 4, "cross_distance")
