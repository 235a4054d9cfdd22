"""The registered queries of the shoreline operators: each reads the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.functions import names
from strandline.operators import components, contours, distance, labels, masks, quality, radiometry, reference, scenes, spatial_join, transects
from strandline.plans.views import ctes, view
from strandline.sources import writers
from strandline.streaming.incremental import order_states

REGION = (0.25, 0.25, 0.75, 0.75)
GEOREF = [0.0, 3.0, 0.0, 0.0, 0.0, -3.0]
#: Reflectance coefficients of the bands 1 to 4.
COEFFICIENTS = [1.9317671190890053e-05, 2.0951514793243966e-05, 2.5218040646164973e-05, 3.9913817560107615e-05]
#: A UTM zone for the synthetic coordinates, and where they start.
ZONE, EAST, NORTH = 32618, 400000.0, 4000000.0
#: Metres of a zone's width that a long shore takes before it goes on in the next zone.
STRETCH = 200000.0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    """Registers a function as a query of its name, with DuckDB SQL over the given views; it may be recursive."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = (ctes(*views).replace("WITH ", "WITH RECURSIVE ", 1) if views else "") + sql
        return f

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- positions on transects ----------------------------------------------------------------------------

_STATS = """, geom AS (SELECT transect_id, date, ((x-x0)*(x1-x0)+(y-y0)*(y1-y0))/sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) AS ch
 FROM shoreline_point JOIN transect ON x BETWEEN x0-1000 AND x0+1000
 WHERE abs(((y-y0)*(x1-x0)-(x-x0)*(y1-y0))/sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0))) <= 25 AND sqrt((x-x0)*(x-x0)+(y-y0)*(y-y0)) <= 1000),
stats AS (SELECT transect_id, date, count(*) AS n, median(ch) AS med, stddev_pop(ch) AS sd, min(ch) AS lo, max(ch) AS hi
 FROM geom WHERE ch >= -100 GROUP BY transect_id, date HAVING count(*) >= 3) """
_MODE = ", multi AS (SELECT s.transect_id, sum(CASE WHEN sd > 15 THEN 1 ELSE 0 END) * 1.0 / (SELECT count(DISTINCT date) FROM shoreline_point) > 0.1 AS use_max FROM stats s GROUP BY s.transect_id) "
_SERIES = ", series AS (SELECT s.transect_id, date, CASE WHEN sd <= 15 AND hi - lo <= 30 THEN med WHEN use_max THEN hi END AS cross_distance FROM stats s JOIN multi USING (transect_id)), kept AS (SELECT * FROM series WHERE cross_distance IS NOT NULL) "
_POINTS = ("transect", "shoreline_point")


def _series(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    return transects.cross_distance(view(spark, sf_dir, "shoreline_point"), view(spark, sf_dir, "transect"), **settings)


@query(_STATS + _MODE + _SERIES + "SELECT transect_id, date, round(cross_distance, 4) AS cross_distance FROM kept", *_POINTS)
def transect_cross_distance(spark, sf_dir):
    return rounded(_series(spark, sf_dir), 4, "cross_distance")


@query(_STATS + "SELECT transect_id, date, round(CASE WHEN sd <= 15 AND hi - lo <= 30 THEN med ELSE hi END, 4) AS cross_distance FROM stats", *_POINTS)
def transect_cross_distance_max(spark, sf_dir):
    return rounded(_series(spark, sf_dir, mode="max"), 4, "cross_distance")


@query(_STATS + "SELECT transect_id, date, round(med, 4) AS cross_distance FROM stats WHERE sd <= 15 AND hi - lo <= 30", *_POINTS)
def transect_cross_distance_nan(spark, sf_dir):
    return rounded(_series(spark, sf_dir, mode="nan"), 4, "cross_distance")


@query(_STATS + "SELECT transect_id, date, n, round(med, 4) AS med, round(sd, 4) AS sd, round(lo, 4) AS lo, round(hi, 4) AS hi FROM stats", *_POINTS)
def intersection_stats(spark, sf_dir):
    return rounded(transects.intersection_stats(view(spark, sf_dir, "shoreline_point"), view(spark, sf_dir, "transect")), 4, "med", "sd", "lo", "hi")


_ON = "x0 + cross_distance * cos(atan2(y1-y0, x1-x0)) AS shore_x, y0 + cross_distance * sin(atan2(y1-y0, x1-x0)) AS shore_y"


@query(
    _STATS + _MODE + _SERIES + f"SELECT date AS dates, x1 AS x, y1 AS y, transect_id, round(cross_distance, 4) AS cross_distance, round(shore_x, 4) AS shore_x, round(shore_y, 4) AS shore_y FROM (SELECT DISTINCT date, x1, y1, transect_id, cross_distance, {_ON} FROM kept JOIN transect USING (transect_id))",
    *_POINTS,
)
def timeseries_merged(spark, sf_dir):
    return rounded(transects.time_series(view(spark, sf_dir, "shoreline_point"), view(spark, sf_dir, "transect")), 4, "cross_distance", "shore_x", "shore_y")


@query(_STATS + _MODE + _SERIES + "SELECT date AS dates, transect_id, round(cross_distance, 4) AS cross_distance FROM kept", *_POINTS)
def timeseries_wide_long(spark, sf_dir):
    return rounded(transects.long_blocks(transects.wide_blocks(_series(spark, sf_dir))), 4, "cross_distance")


@query(_STATS + _MODE + _SERIES + ", s AS (SELECT *, CASE WHEN month(date) IN (12, 1, 2) THEN 'DJF' WHEN month(date) < 6 THEN 'MAM' WHEN month(date) < 9 THEN 'JJA' ELSE 'SON' END AS season FROM kept) SELECT transect_id, season, round(avg(cross_distance) + 1e-7, 4) AS mean_distance, count(*) AS n FROM s GROUP BY transect_id, season", *_POINTS)
def seasonal_shoreline(spark, sf_dir):
    # means of many terms may end on a rounding tie, where the order of the sum decides: both sides step off it
    means = transects.seasonal_means(_series(spark, sf_dir))
    return rounded(means.withColumn("mean_distance", F.col("mean_distance") + 1e-7), 4, "mean_distance")


@query("SELECT transect_id, x1 AS x, y1 AS y FROM transect", "transect")
def seaward_points(spark, sf_dir):
    return transects.seaward_points(view(spark, sf_dir, "transect"))


_CHECKED = """, shifted AS (SELECT transect_id, CAST(x0 AS DOUBLE) AS px, CAST(y0 + k * 75 AS DOUBLE) AS py, k, concat(transect_id, '/', CAST(k AS STRING)) AS row_id, x0, y0, x1, y1 FROM transect, range(0, 4) r(k)),
placed AS (SELECT row_id, transect_id, CASE WHEN CAST(substr(transect_id, 2) AS INT) % 7 = 0 AND k = 2 THEN px + 100 WHEN CAST(substr(transect_id, 2) AS INT) % 5 = 0 AND k = 3 THEN px + 37 ELSE x0 + (x1 - x0) * k / 4 END AS shore_x,
 CASE WHEN CAST(substr(transect_id, 2) AS INT) % 7 = 0 AND k = 2 THEN 0 ELSE y0 + (y1 - y0) * k / 4 END AS shore_y FROM shifted),
dist AS (SELECT p.row_id, p.transect_id, t.transect_id AS other, sqrt(power(shore_x - (x0 + greatest(0, least(1, ((shore_x-x0)*(x1-x0)+(shore_y-y0)*(y1-y0))/((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)))) * (x1-x0)), 2) + power(shore_y - (y0 + greatest(0, least(1, ((shore_x-x0)*(x1-x0)+(shore_y-y0)*(y1-y0))/((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)))) * (y1-y0)), 2)) AS d FROM placed p JOIN transect t ON abs(t.x0 - p.shore_x) < 1000),
verdict AS (SELECT row_id, transect_id, bool_or(other = transect_id AND d <= 1e-6) AS own_ok, bool_or(d <= 1e-6) AS any_ok FROM dist GROUP BY row_id, transect_id),
vetoed AS (SELECT DISTINCT transect_id FROM verdict WHERE any_ok AND NOT own_ok) """


def _placed(spark, sf_dir):
    t = view(spark, sf_dir, "transect").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    n = F.substring("transect_id", 2, 20).cast("int")
    stray, off = (n % 7 == 0) & (F.col("k") == 2), (n % 5 == 0) & (F.col("k") == 3)
    x = F.when(stray, F.col("x0") + 100).when(off, F.col("x0") + 37).otherwise(F.col("x0") + (F.col("x1") - F.col("x0")) * F.col("k") / 4)
    y = F.when(stray, 0.0).otherwise(F.col("y0") + (F.col("y1") - F.col("y0")) * F.col("k") / 4)
    return t.select(F.concat_ws("/", "transect_id", F.col("k").cast("string")).alias("row_id"), "transect_id", x.alias("shore_x"), y.alias("shore_y"))


@query(_CHECKED + "SELECT row_id, transect_id, round(shore_x, 4) AS shore_x, round(shore_y, 4) AS shore_y FROM placed JOIN verdict USING (row_id, transect_id) WHERE own_ok AND transect_id NOT IN (SELECT transect_id FROM vetoed)", "transect")
def points_on_transects(spark, sf_dir):
    return rounded(transects.on_transects(_placed(spark, sf_dir), view(spark, sf_dir, "transect"), 1e-6)[0], 4, "shore_x", "shore_y").select("row_id", "transect_id", "shore_x", "shore_y")


@query(_CHECKED + "SELECT row_id, transect_id, round(shore_x, 4) AS shore_x, round(shore_y, 4) AS shore_y FROM placed JOIN verdict USING (row_id, transect_id) WHERE NOT (own_ok AND transect_id NOT IN (SELECT transect_id FROM vetoed))", "transect")
def dropped_points(spark, sf_dir):
    return rounded(transects.on_transects(_placed(spark, sf_dir), view(spark, sf_dir, "transect"), 1e-6)[1], 4, "shore_x", "shore_y")


@query(_STATS + _MODE + _SERIES + "SELECT transect_id, date, round(cross_distance, 4) AS cross_distance FROM kept WHERE NOT (month(date) = 6 AND cross_distance > 100)", *_POINTS)
def series_without_dropped(spark, sf_dir):
    s = _series(spark, sf_dir)
    return rounded(transects.without(s, s.where((F.month("date") == 6) & (F.col("cross_distance") > 100))), 4, "cross_distance").select("transect_id", "date", "cross_distance")


@query("SELECT date, count(*) AS n, round(sum(x), 3) AS sx, round(sum(y), 3) AS sy FROM shoreline_point GROUP BY date", "shoreline_point")
def points_by_date(spark, sf_dir):
    v = view(spark, sf_dir, "shoreline_point").withColumn("line", F.lit(0)).withColumn("seq", F.lit(0))
    total = lambda k: F.round(F.aggregate("points", F.lit(0.0), lambda t, p: t + p[k]), 3)
    return transects.points_by_date(v).select("date", F.size("points").cast("long").alias("n"), total("x").alias("sx"), total("y").alias("sy"))


@query(
    _STATS
    + _MODE
    + _SERIES
    + f""", p AS (SELECT DISTINCT date, round(x, 4) AS x, round(y, 4) AS y FROM (SELECT date, {_ON.replace("shore_x", "x").replace("shore_y", "y")} FROM kept JOIN transect USING (transect_id))),
w(date, seq, cur, rest) AS (SELECT date, 0, v[1], v[2:] FROM (SELECT date, list_sort(list({{'x': x, 'y': y}})) AS v FROM p GROUP BY date HAVING count(*) > 1)
 UNION ALL SELECT date, seq + 1, {{'x': best.x, 'y': best.y}}, list_filter(rest, lambda q: q.x <> best.x OR q.y <> best.y)
 FROM (SELECT *, list_min(list_transform(rest, lambda q: {{'d': (q.x - cur.x) * (q.x - cur.x) + (q.y - cur.y) * (q.y - cur.y), 'x': q.x, 'y': q.y}})) AS best FROM w WHERE len(rest) > 0))
SELECT date, seq, cur.x AS x, cur.y AS y FROM w""",
    *_POINTS,
)
def ordered_lines(spark, sf_dir):
    # rounded before the walk: a tie may not hang on an engine's last digit
    return transects.dated_lines(rounded(_series_points(spark, sf_dir), 4, "x", "y"))


def _series_points(spark, sf_dir):
    s = transects.shore_points(_series(spark, sf_dir), view(spark, sf_dir, "transect"))
    return s.select("date", F.col("shore_x").alias("x"), F.col("shore_y").alias("y"))


@query(_STATS + _MODE + _SERIES + "SELECT transect_id, count(*) AS n, round(min(cross_distance), 4) AS lo, strftime(min(date), '%Y-%m-%dT00:00:00') AS first FROM kept GROUP BY transect_id", *_POINTS)
def distance_arrays(spark, sf_dir):
    d = writers.distances(_series(spark, sf_dir).withColumnRenamed("date", "dates"))
    return d.select("transect_id", F.size("dates").cast("long").alias("n"), F.round(F.array_min("cross_distance"), 4).alias("lo"), F.element_at("dates", 1).alias("first"))


# --- distance joins ------------------------------------------------------------------------------------

_FAR = "SELECT date, x, y FROM shoreline_point p WHERE NOT EXISTS (SELECT 1 FROM reference_vertex m WHERE m.x BETWEEN p.x - 45 AND p.x + 45 AND (p.x-m.x)*(p.x-m.x)+(p.y-m.y)*(p.y-m.y) < 45*45)"


@query(_FAR, "shoreline_point", "reference_vertex")
def mask_distance_filter(spark, sf_dir):
    return spatial_join.away_from_mask(view(spark, sf_dir, "shoreline_point"), view(spark, sf_dir, "reference_vertex"), 45)


@query("SELECT transect_id FROM transect WHERE x0 BETWEEN 500 AND 2500 OR x1 BETWEEN 500 AND 2500", "transect")
def transects_in_region(spark, sf_dir):
    ring = F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ((500, -10), (2500, -10), (2500, 400), (500, 400))])
    regions = spark.range(1).select(ring.alias("ring"))
    return spatial_join.transects_in_regions(view(spark, sf_dir, "transect"), regions).select("transect_id")


# --- catalogue -----------------------------------------------------------------------------------------

_FOUND = f" scene_item WHERE minx <= {REGION[2]} AND {REGION[0]} <= maxx AND miny <= {REGION[3]} AND {REGION[1]} <= maxy AND acquired > TIMESTAMP '2020-01-01 00:00:00' AND acquired < TIMESTAMP '2030-01-01 00:00:00' AND cloud_cover <= 0.6"


@query(
    f"SELECT scene_id, cloud_cover, round(area, 6) AS area FROM (SELECT *, greatest(least(maxx, 0.75) - greatest(minx, 0.25), 0) * greatest(least(maxy, 0.75) - greatest(miny, 0.25), 0) AS area FROM {_FOUND} AND month(acquired) IN (1, 2, 3, 7)) WHERE area > 0.5 * 0.25",
    "scene_item",
)
def scene_search(spark, sf_dir):
    import datetime as dt

    found = scenes.search(view(spark, sf_dir, "scene_item"), REGION, dt.datetime(2020, 1, 1), dt.datetime(2030, 1, 1), 0.6)
    return rounded(scenes.covering(scenes.in_months(found, ["01", "02", "03", "07"]), REGION), 6, "area").select("scene_id", "cloud_cover", "area")


@query("SELECT CAST(acquired AS DATE) AS date, count(*) AS n, min(scene_id) AS first, max(scene_id) AS last FROM scene_item GROUP BY 1", "scene_item")
def ids_by_date(spark, sf_dir):
    d = scenes.ids_by_date(view(spark, sf_dir, "scene_item"))
    return d.select("date", F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("first"), F.element_at("ids", -1).alias("last"))


@query(
    ", o AS (SELECT scene_id, (row_number() OVER (ORDER BY CAST(acquired AS DATE), seq) - 1) // 499 + 1 AS batch FROM scene_item) SELECT CAST(batch AS INT) AS batch, concat('site_batch_', CAST(batch AS STRING), '_', CAST(count(*) + 1 AS STRING)) AS name, CAST(count(*) + 1 AS INT) AS n, min(scene_id) AS lo FROM o GROUP BY batch",
    "scene_item",
)
def scene_batches(spark, sf_dir):
    b = scenes.batches(view(spark, sf_dir, "scene_item"), "site", coregister_id="0")
    lo = F.array_min(F.transform(F.slice("ids", 1, F.col("n") - 1), lambda i: i.cast("long")))
    return b.select("batch", "name", "n", lo.alias("lo"))


@query("SELECT arg_min(scene_id, (cloud_cover, seq)) AS scene_id FROM scene_item", "scene_item")
def lowest_cloud_scene(spark, sf_dir):
    return scenes.least_cloud(view(spark, sf_dir, "scene_item"))


@query(
    ", b AS (SELECT date_acquired, cloud_cover, acc_georef FROM date_cloud JOIN date_meta USING (date_acquired)), s AS (SELECT *, (0.7 * acc_georef / (SELECT max(acc_georef) FROM b) + 0.3 * cloud_cover / (SELECT max(cloud_cover) FROM b)) * CASE WHEN cloud_cover < 0.05 THEN 0.8 ELSE 1 END AS score FROM b) SELECT date_acquired, cloud_cover, acc_georef, round(score, 6) AS score FROM s ORDER BY s.score, date_acquired LIMIT 1",
    "date_cloud",
    "date_meta",
)
def best_scored_date(spark, sf_dir):
    return rounded(scenes.best_scored(view(spark, sf_dir, "date_cloud"), view(spark, sf_dir, "date_meta")), 6, "score")


@query("SELECT DISTINCT order_id FROM scene_order WHERE (name = 'site3' OR regexp_matches(name, '^site3(_batch.*)?$')) AND state IN ('success', 'running')", "scene_order")
def order_match(spark, sf_dir):
    return scenes.matching_orders(view(spark, sf_dir, "scene_order"), "site3", ["success", "running"])


@query("SELECT site AS order_id, arg_max(state, (changed, state)) AS state, max(changed) AS changed, arg_max(state, (changed, state)) IN ('success', 'failed', 'cancelled') AS done FROM scene_order GROUP BY site", "scene_order")
def order_state(spark, sf_dir):
    return order_states(view(spark, sf_dir, "scene_order").select(F.col("site").alias("order_id"), "state", "changed"))


@query("SELECT scene_id, instrument, 20230101 + scene_id % 28 AS day, concat('id', CAST(scene_id AS STRING), '_', instrument) AS base, CASE instrument WHEN 'click' THEN '_C.tif' ELSE '_UNKNOWN_TOA.tif' END AS suffix FROM scene_item", "scene_item")
def scene_names(spark, sf_dir):
    s = view(spark, sf_dir, "scene_item")
    day = (F.lit(20230101) + F.col("scene_id") % 28).alias("day")
    name = F.concat(F.lit("id"), F.col("scene_id").cast("string"), F.lit("_"), F.col("instrument"), F.lit("_3B_x.tif"))
    return s.select("scene_id", "instrument", day, names.base_name(name).alias("base"), names.sensor_suffix(F.col("instrument"), {"click": "_C.tif"}).alias("suffix"))


@query("SELECT scene_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k FROM scene_item", "scene_item")
def scene_property(spark, sf_dir):
    return scenes.nested_property(view(spark, sf_dir, "scene_item"), "k", -1, "k", "props").select("scene_id", "k")


# --- verdicts ------------------------------------------------------------------------------------------

_VERDICT = "CASE WHEN 1/(1+exp(-logit)) > 1 - 1/(1+exp(-logit)) THEN 'good' ELSE 'bad' END AS im_classes, round(greatest(1/(1+exp(-logit)), 1 - 1/(1+exp(-logit))), 6) AS im_scores"


@query(f"SELECT im_paths, {_VERDICT} FROM classifier_logit", "classifier_logit")
def scene_verdict(spark, sf_dir):
    return rounded(quality.verdicts(view(spark, sf_dir, "classifier_logit")), 6, "im_scores").select("im_paths", "im_classes", "im_scores")


@query(f"SELECT im_paths, CASE WHEN already_scored THEN 'old' ELSE c END AS im_classes, CASE WHEN already_scored THEN 0 ELSE s END AS im_scores FROM (SELECT im_paths, already_scored, {_VERDICT.replace('im_classes', 'c').replace('im_scores', 's')} FROM classifier_logit)", "classifier_logit")
def resume_verdict(spark, sf_dir):
    images = view(spark, sf_dir, "classifier_logit")
    old = images.where("already_scored").select("im_paths", F.lit("old").alias("im_classes"), F.lit(0.0).alias("im_scores"))
    new = quality.verdicts(quality.not_yet_scored(images, old)).select("im_paths", "im_classes", "im_scores")
    return rounded(quality.merged(old, new), 6, "im_scores").select("im_paths", "im_classes", "im_scores")


# --- pixels --------------------------------------------------------------------------------------------

_COEFF = "CASE band WHEN 1 THEN CAST(1.9317671190890053e-05 AS DOUBLE) WHEN 2 THEN CAST(2.0951514793243966e-05 AS DOUBLE) WHEN 3 THEN CAST(2.5218040646164973e-05 AS DOUBLE) ELSE CAST(3.9913817560107615e-05 AS DOUBLE) END"


def _coefficients(spark):
    return spark.createDataFrame(list(enumerate(COEFFICIENTS, 1)), "band int, coeff double")


@query(f"SELECT scene_id, row, col, band, CAST(floor(dn * {_COEFF} * 10000) AS INT) AS toa FROM band_pixel", "band_pixel")
def toa_reflectance(spark, sf_dir):
    return radiometry.reflectance(view(spark, sf_dir, "band_pixel"), _coefficients(spark)).select("scene_id", "row", "col", "band", "toa")


@query(
    ", e AS (SELECT scene_id, band, min(dn) AS lo, max(dn) AS hi FROM band_pixel GROUP BY scene_id, band) SELECT scene_id, row, col, CASE WHEN band <= 3 THEN 4 - band ELSE band END AS band, CAST(CASE WHEN hi > lo THEN floor((dn - lo) / CAST(hi - lo AS DOUBLE) * 255) ELSE 0 END AS INT) AS stretched FROM band_pixel JOIN e USING (scene_id, band) WHERE band <= 3",
    "band_pixel",
)
def band_stretch_rgb(spark, sf_dir):
    return radiometry.stretched(radiometry.to_rgb(view(spark, sf_dir, "band_pixel"))).select("scene_id", "row", "col", "band", "stretched")


@query("SELECT scene_id, band, min(dn) AS lo, max(dn) AS hi, round(avg(dn), 4) AS mean, round(stddev_pop(dn), 4) AS sd, count(dn) AS n FROM band_pixel GROUP BY scene_id, band", "band_pixel")
def band_stats(spark, sf_dir):
    return rounded(radiometry.band_stats(view(spark, sf_dir, "band_pixel")), 4, "mean", "sd")


@query(
    ", e AS (SELECT scene_id, band, min(dn) AS lo, max(dn) AS hi FROM band_pixel GROUP BY scene_id, band) SELECT scene_id, band, CAST(CASE WHEN hi > lo THEN least(floor((dn - lo) / CAST(hi - lo AS DOUBLE) * 16), 15) ELSE 0 END AS INT) AS bucket, count(*) AS n FROM band_pixel JOIN e USING (scene_id, band) GROUP BY ALL",
    "band_pixel",
)
def band_histogram(spark, sf_dir):
    return radiometry.band_histogram(view(spark, sf_dir, "band_pixel"), 16)


@query("SELECT scene_id, row, col, shadow OR cloud OR nodata AS bad, shadow OR cloud AS cloudy FROM udm_pixel", "udm_pixel")
def udm_mask(spark, sf_dir):
    return view(spark, sf_dir, "udm_pixel").select("scene_id", "row", "col", masks.bad_pixel().alias("bad"), masks.cloud_or_shadow().alias("cloudy"))


@query("SELECT scene_id, round(avg(CASE WHEN qa & 14 <> 0 THEN 1 ELSE 0 END), 3) AS cloud_cover FROM udm_pixel GROUP BY scene_id", "udm_pixel")
def qa_cloud_cover(spark, sf_dir):
    return masks.cloud_cover(view(spark, sf_dir, "udm_pixel"), masks.qa_cloud("qa"))


def _patches_sql(k: str = "") -> str:
    """patch (scene_id, row, col, component, size) of the true pixels p (scene_id, row, col): runs of a row that touch
    runs of the next one, their reach, and the least pixel in it. All names end in ``k``."""
    touch = f"reach{k}.scene_id = touch{k}.scene_id AND reach{k}.r2 = touch{k}.r AND reach{k}.c2 = touch{k}.c"
    return f""", runs{k} AS (SELECT scene_id, row, min(col) AS lo, max(col) AS hi FROM (SELECT *, col - row_number() OVER (PARTITION BY scene_id, row ORDER BY col) AS g FROM p{k}) GROUP BY scene_id, row, g),
touch{k} AS (SELECT a.scene_id, a.row AS r, a.lo AS c, b.row AS r2, b.lo AS c2 FROM runs{k} a JOIN runs{k} b ON a.scene_id = b.scene_id AND (a.row = b.row + 1 OR a.row = b.row - 1) AND a.lo <= b.hi AND b.lo <= a.hi),
reach{k}(scene_id, r, c, r2, c2) AS (SELECT scene_id, row, lo, row, lo FROM runs{k} UNION SELECT reach{k}.scene_id, reach{k}.r, reach{k}.c, touch{k}.r2, touch{k}.c2 FROM reach{k} JOIN touch{k} ON {touch}),
root{k} AS (SELECT scene_id, r, c, min(CAST(r2 AS BIGINT) * 4294967296 + c2) AS component FROM reach{k} GROUP BY scene_id, r, c),
patch{k} AS (SELECT p.scene_id, p.row, p.col, component, count(*) OVER (PARTITION BY p.scene_id, component) AS size FROM p{k} p JOIN runs{k} q ON p.scene_id = q.scene_id AND p.row = q.row AND p.col BETWEEN lo AND hi
 JOIN root{k} t ON t.scene_id = p.scene_id AND r = p.row AND c = lo)"""


def _without_specks_sql(least: int) -> str:
    """keep (scene_id, row, col, cloud) of f (scene_id, row, col, cloud) without patches of under ``least`` pixels."""
    return (
        ", p AS (SELECT scene_id, row, col FROM f WHERE cloud)"
        + _patches_sql()
        + ", mixed AS (SELECT scene_id, bool_or(cloud) AND NOT bool_and(cloud) AS two FROM f GROUP BY scene_id)"
        + f", keep AS (SELECT f.scene_id, f.row, f.col, CASE WHEN two THEN coalesce(size >= {least}, false) ELSE cloud END AS cloud FROM f JOIN mixed USING (scene_id) LEFT JOIN patch USING (scene_id, row, col))"
    )


_RAW_CLOUD = "SELECT scene_id, row, col, qa & 14 <> 0 AS cloud FROM udm_pixel"


@query(f", f AS ({_RAW_CLOUD})" + _without_specks_sql(40) + " SELECT scene_id, round(avg(CASE WHEN cloud THEN 1 ELSE 0 END), 3) AS cloud_cover FROM keep GROUP BY scene_id", "udm_pixel")
def scene_cloud_cover(spark, sf_dir):
    # the cloud cover of a scene's file; qa_cloud_cover is the share of the raw bits
    pixels = view(spark, sf_dir, "udm_pixel").select("scene_id", "row", "col", masks.qa_cloud("qa").alias("cloud"))
    return masks.cloud_cover(masks.without_specks(pixels, "cloud", 40), F.col("cloud"))


@query("SELECT scene_id, row, col FROM udm_pixel WHERE elevation > -1 AND elevation < 2", "udm_pixel")
def elevation_mask(spark, sf_dir):
    return view(spark, sf_dir, "udm_pixel").where(masks.in_band("elevation", -1, 2)).select("scene_id", "row", "col")


@query("SELECT scene_id, row, col, label IN (0, 1) OR shadow OR cloud OR nodata AS masked FROM label_pixel JOIN udm_pixel USING (scene_id, row, col)", "label_pixel", "udm_pixel")
def water_bad_mask(spark, sf_dir):
    return masks.combined(view(spark, sf_dir, "label_pixel"), view(spark, sf_dir, "udm_pixel"), masks.is_water("label"), masks.bad_pixel())


@query("SELECT scene_id, row, col, CAST(arg_min(class_idx, (-score, class_idx)) AS INT) AS label FROM class_score GROUP BY scene_id, row, col", "class_score")
def label_argmax(spark, sf_dir):
    return labels.argmax(view(spark, sf_dir, "class_score"))


@query("SELECT scene_id, label, count(*) AS n FROM label_pixel GROUP BY scene_id, label", "label_pixel")
def label_histogram(spark, sf_dir):
    return labels.histogram(view(spark, sf_dir, "label_pixel"))


@query("SELECT scene_id, row, col, round((avg(CASE WHEN class_idx = 1 THEN score END) + 1 - avg(CASE WHEN class_idx = 0 THEN score END)) / 2, 6) AS est FROM class_score GROUP BY scene_id, row, col", "class_score")
def binary_estimate(spark, sf_dir):
    return rounded(labels.binary_estimate(view(spark, sf_dir, "class_score")), 6, "est")


@query(
    """, e AS (SELECT scene_id, min(score) AS lo, max(score) AS hi FROM class_score GROUP BY scene_id),
h AS (SELECT scene_id, lo, hi, CAST(least(floor((score - lo) / (hi - lo) * 256), 255) AS INT) AS b, count(*) AS n FROM class_score JOIN e USING (scene_id) GROUP BY ALL),
c AS (SELECT *, lo + (b + 0.5) * (hi - lo) / 256 AS m FROM h),
w AS (SELECT *, sum(n) OVER (PARTITION BY scene_id) AS t, sum(n * m) OVER (PARTITION BY scene_id) AS s, sum(n) OVER (PARTITION BY scene_id ORDER BY b) AS w0, sum(n * m) OVER (PARTITION BY scene_id ORDER BY b) AS s0 FROM c)
SELECT scene_id, round(arg_max(m, (v, -b)), 6) AS threshold FROM (SELECT *, CASE WHEN t > w0 THEN w0 * (t - w0) * power(s0 / w0 - (s - s0) / (t - w0), 2) ELSE 0 END AS v FROM w) GROUP BY scene_id""",
    "class_score",
)
def otsu_threshold(spark, sf_dir):
    return rounded(radiometry.otsu(view(spark, sf_dir, "class_score"), ["scene_id"], "score"), 6, "threshold")


# --- neighbourhoods and contours -----------------------------------------------------------------------

_BUFFER = """, v AS (SELECT DISTINCT CAST(round(y / 3) AS INT) AS r, CAST(round(x / 3) AS INT) AS c FROM reference_vertex),
g AS (SELECT greatest(64, max(r) + 5) AS n_rows, greatest(4000, max(c) + 5) AS n_cols FROM v),
i AS (SELECT r, c, n_rows, n_cols FROM v, g WHERE r > 0 AND r < n_rows AND c > 0 AND c < n_cols),
o AS (SELECT a.k AS dr, b.k AS dc FROM range(-4, 5) a(k), range(-4, 5) b(k) WHERE a.k * a.k + b.k * b.k <= 16)
SELECT DISTINCT CAST(r + dr AS BIGINT) AS row, CAST(c + dc AS BIGINT) AS col FROM i, o WHERE r + dr BETWEEN 0 AND n_rows - 1 AND c + dc BETWEEN 0 AND n_cols - 1"""


@query(_BUFFER, "reference_vertex")
def reference_buffer(spark, sf_dir):
    vertices, georef = view(spark, sf_dir, "reference_vertex"), [0.0, 3.0, 0.0, 0.0, 0.0, 3.0]
    n_rows, n_cols = masks.grid_over(vertices, georef, 10)
    b = masks.reference_buffer(vertices, georef, max(64, n_rows), max(4000, n_cols), 10)
    return b.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))


_SEG = """, s AS (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY seq) AS x1, lead(y) OVER (ORDER BY seq) AS y1 FROM reference_vertex),
p AS (SELECT scene_id, row, col, (col + 0.5) * 3 AS px, (row + 0.5) * 3 AS py FROM label_pixel)
SELECT scene_id, row, col FROM p WHERE EXISTS (SELECT 1 FROM s WHERE x1 IS NOT NULL AND x0 < px + 150 AND power(px - (x0 + greatest(0, least(1, ((px-x0)*(x1-x0)+(py-y0)*(y1-y0))/((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)))) * (x1-x0)), 2) + power(py - (y0 + greatest(0, least(1, ((px-x0)*(x1-x0)+(py-y0)*(y1-y0))/((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)))) * (y1-y0)), 2) <= 40.0 * 40.0)"""


@query(_SEG, "label_pixel", "reference_vertex")
def reference_line_buffer(spark, sf_dir):
    pixels = view(spark, sf_dir, "label_pixel").select("scene_id", "row", "col")
    return masks.line_buffer(pixels, view(spark, sf_dir, "reference_vertex"), [0.0, 3.0, 0.0, 0.0, 0.0, 3.0], 40)


def _land(spark, sf_dir):
    return view(spark, sf_dir, "label_pixel").select("scene_id", "row", "col", (F.col("label") > 1).alias("land"))


@query(
    ", g AS (SELECT scene_id, row - i AS row, col - j AS col, CASE WHEN label > 1 THEN (1 + 3 * i) * (1 + j) ELSE 0 END AS v FROM label_pixel, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(i, j))"
    " SELECT scene_id, row, col, CAST(sum(v) AS INT) AS \"case\" FROM g GROUP BY scene_id, row, col HAVING count(*) = 4",
    "label_pixel",
)
def contour_cells(spark, sf_dir):
    return contours.cells(_land(spark, sf_dir).withColumn("value", F.col("land").cast("double")))


@query(
    ", o AS (SELECT a.i, b.i AS j, a.i * a.i + b.i * b.i AS square FROM range(-12, 13) a(i), range(-12, 13) b(i))"
    " SELECT scene_id, CAST(row + i AS BIGINT) AS row, CAST(col + j AS BIGINT) AS col, min(square) AS square FROM udm_pixel, o WHERE cloud AND square <= 144 GROUP BY ALL",
    "udm_pixel",
)
def cloud_distances(spark, sf_dir):
    found = distance.distances(view(spark, sf_dir, "udm_pixel").where("cloud"), 12)
    return found.withColumns({c: F.col(c).cast("long") for c in ("row", "col")})


_W = "PARTITION BY scene_id, {0} ORDER BY {1} ROWS BETWEEN {2}"


def _opening_sql(size: int, raw: str = "SELECT scene_id, row, col, label > 1 AS land FROM label_pixel", flag: str = "land") -> str:
    f, b = f"CURRENT ROW AND {size - 1} FOLLOWING", f"{size - 1} PRECEDING AND CURRENT ROW"
    steps = [("min", "row", "col", f), ("min", "col", "row", f), ("max", "row", "col", b), ("max", "col", "row", b)]
    q = f"SELECT scene_id, row, col, CASE WHEN {flag} THEN 1 ELSE 0 END AS v FROM ({raw})"
    for fn, p, o, frame in steps:
        q = f"SELECT scene_id, row, col, {fn}(v) OVER ({_W.format(p, o, frame)}) AS v FROM ({q})"
    return f"SELECT scene_id, row, col, v = 1 AS {flag} FROM ({q})"


@query(_opening_sql(3), "label_pixel")
def binary_opening(spark, sf_dir):
    return masks.opened(_land(spark, sf_dir), "land", 3, tile=16).select("scene_id", "row", "col", "land")


@query(", p AS (SELECT scene_id, row, col FROM label_pixel WHERE label > 1)" + _patches_sql() + " SELECT scene_id, row, col, component, size FROM patch WHERE size >= 100", "label_pixel")
def small_objects(spark, sf_dir):
    return components.patches(_land(spark, sf_dir).where("land"), 100, tile=16)


def _chains_sql(tail: str) -> str:
    """walk (scene_id, hr, hc, seq, r, c): each line of s (scene_id, r0, c0, r1, c1), walked from where nothing comes,
    then each ring from its least vertex: the only one from which no walk meets a lesser one."""
    ends = {"T": "2 * row, 2 * col + 1", "B": "2 * row + 2, 2 * col + 1", "L": "2 * row + 1, 2 * col", "R": "2 * row + 1, 2 * col + 2"}
    pieces = [f"SELECT scene_id, {ends[p[0]]}, {ends[p[1]]} FROM cells WHERE \"case\" = {case}" for case, parts in contours.SEGMENTS.items() for p in parts]
    on = "ON s.scene_id = w.scene_id AND s.r0 = w.r AND s.c0 = w.c"
    return (
        f", s(scene_id, r0, c0, r1, c1) AS ({' UNION ALL '.join(pieces)}),"
        " w(scene_id, hr, hc, seq, r, c) AS (SELECT scene_id, r0, c0, 0, r0, c0 FROM s WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.scene_id = s.scene_id AND b.r1 = s.r0 AND b.c1 = s.c0)"
        f" UNION ALL SELECT w.scene_id, hr, hc, seq + 1, r1, c1 FROM w JOIN s {on}),"
        " rest AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.scene_id = s.scene_id AND w.r = s.r0 AND w.c = s.c0)),"
        " turn(scene_id, hr, hc, seq, r, c) AS (SELECT scene_id, r0, c0, 0, r0, c0 FROM rest"
        f" UNION ALL SELECT w.scene_id, hr, hc, seq + 1, r1, c1 FROM turn w JOIN s {on} WHERE (seq = 0 OR w.r <> hr OR w.c <> hc) AND (r1 > hr OR r1 = hr AND c1 >= hc)),"
        " walk AS (SELECT * FROM w UNION ALL SELECT * FROM turn WHERE (scene_id, hr, hc) IN (SELECT (scene_id, hr, hc) FROM turn WHERE seq > 0 AND r = hr AND c = hc))" + tail
    )


_CELLS = (
    ", g AS (SELECT scene_id, row - i AS row, col - j AS col, CASE WHEN label > 1 THEN (1 + 3 * i) * (1 + j) ELSE 0 END AS v FROM label_pixel, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(i, j)),"
    " cells AS (SELECT scene_id, row, col, CAST(sum(v) AS INT) AS \"case\" FROM g GROUP BY scene_id, row, col HAVING count(*) = 4)"
)


@query(
    _CELLS
    + _chains_sql(" SELECT scene_id, min(CAST(r AS BIGINT) * 4294967296 + c) OVER (PARTITION BY scene_id, hr, hc) AS contour_id, 0 AS part, seq, r / 2.0 AS row, c / 2.0 AS col FROM walk"),
    "label_pixel",
)
def land_contours(spark, sf_dir):
    return contours.chained(contours.segments(_land(spark, sf_dir).withColumn("value", F.col("land").cast("double"))))


def _long_sql(name: str, source: str, least: float) -> str:
    """``name``: the lines of ``source`` (scene_id, contour_id, seq, x, y) with two vertices and this length."""
    own = "PARTITION BY scene_id, contour_id"
    step = f"sqrt(power(x - lag(x) OVER ({own} ORDER BY seq), 2) + power(y - lag(y) OVER ({own} ORDER BY seq), 2))"
    return f", {name} AS (SELECT scene_id, contour_id, seq, x, y FROM (SELECT *, sum(d) OVER ({own}) AS l, count(*) OVER ({own}) AS n FROM (SELECT *, {step} AS d FROM {source})) WHERE n >= 2 AND l >= {least})"


_SHORELINES = (
    ", f AS (SELECT scene_id, row, col, cloud OR shadow AS cloud FROM udm_pixel)"
    + _without_specks_sql(40)
    + ", flag AS (SELECT scene_id, row, col, label > 1 AS land, keep.cloud, nodata FROM label_pixel JOIN keep USING (scene_id, row, col) JOIN (SELECT scene_id, row, col, nodata FROM udm_pixel) u USING (scene_id, row, col)),"
    " p_land AS (SELECT scene_id, row, col FROM flag WHERE land)"
    + _patches_sql("_land")
    + ", near AS (SELECT * FROM (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY seq) AS x1, lead(y) OVER (ORDER BY seq) AS y1 FROM reference_vertex) WHERE x1 IS NOT NULL),"
    " centre AS (SELECT scene_id, row, col, (col + 0.5) * 3 AS px, (row + 0.5) * 3 AS py FROM flag WHERE NOT cloud AND NOT nodata),"
    " foot AS (SELECT scene_id, row, col, px, py, x0, y0, x1, y1, greatest(0, least(1, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS u FROM centre JOIN near ON x0 < px + 250),"
    " seen AS (SELECT DISTINCT scene_id, row, col FROM foot WHERE power(px - x0 - u * (x1 - x0), 2) + power(py - y0 - u * (y1 - y0), 2) <= 10000),"
    " v AS (SELECT scene_id, row, col, CASE WHEN size >= 100 THEN 1 ELSE 0 END AS high FROM seen LEFT JOIN patch_land USING (scene_id, row, col)),"
    " g AS (SELECT scene_id, row - i AS row, col - j AS col, high * (1 + 3 * i) * (1 + j) AS k FROM v, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(i, j)),"
    ' cells AS (SELECT scene_id, row, col, CAST(sum(k) AS INT) AS "case" FROM g GROUP BY scene_id, row, col HAVING count(*) = 4)'
    + _chains_sql(", line AS (SELECT scene_id, min(CAST(r AS BIGINT) * 4294967296 + c) OVER (PARTITION BY scene_id, hr, hc) AS contour_id, seq, c * 1.5 AS x, r * -1.5 AS y FROM walk)")
    + _long_sql("long", "line", 30)
    + ", far AS (SELECT * FROM long WHERE NOT EXISTS (SELECT 1 FROM flag WHERE flag.scene_id = long.scene_id AND (cloud OR nodata) AND power(col * 3 - x, 2) + power(row * -3 - y, 2) < 3600))"
    + _long_sql("done", "far", 30)
    + " SELECT scene_id, contour_id, 0 AS part, seq, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM done"
)


@query(_SHORELINES, "label_pixel", "udm_pixel", "reference_vertex")
def shoreline_pipeline(spark, sf_dir):
    # cloud and shadow are one mask to the operator; its specks go together, wherever they are
    udm = view(spark, sf_dir, "udm_pixel").withColumn("cloud", masks.cloud_or_shadow()).withColumn("shadow", F.lit(False))
    udm = masks.without_specks(udm, "cloud", 40)
    pixels = view(spark, sf_dir, "label_pixel")
    buffer = masks.line_buffer(pixels.select("scene_id", "row", "col"), view(spark, sf_dir, "reference_vertex"), [0.0, 3.0, 0.0, 0.0, 0.0, 3.0], 100)
    return contours.shorelines(pixels, udm, GEOREF, buffer=buffer, least_patch=100, least_length=30)


@query(", f AS (" + _opening_sql(2, _RAW_CLOUD, "cloud") + ")" + _without_specks_sql(10) + " SELECT scene_id, row, col, cloud FROM keep", "udm_pixel")
def cloud_mask_job(spark, sf_dir):
    return masks.cloud_mask(view(spark, sf_dir, "udm_pixel").select("scene_id", "row", "col", F.col("qa").alias("qa")), opening=2, least=10)


@query(", d AS (SELECT scene_id, row, col, (col + 0.5) * 2 AS x, (row + 0.5) * 2 AS y FROM label_pixel) SELECT d.scene_id, d.row, d.col, coalesce(s.label, -1) AS label FROM d LEFT JOIN label_pixel s ON d.scene_id = s.scene_id AND s.row = floor(d.y / 3) AND s.col = floor(d.x / 3)", "label_pixel")
def resampled_labels(spark, sf_dir):
    p = view(spark, sf_dir, "label_pixel")
    return spatial_join.resampled(p.select("scene_id", "row", "col"), p, [0.0, 2.0, 0.0, 0.0, 0.0, 2.0], [0.0, 3.0, 0.0, 0.0, 0.0, 3.0], "label", -1)


@query("SELECT scene_id, row, col, band, CASE WHEN (col + 0.5) * 3 - 6 < (row + 0.5) * 3 THEN dn ELSE 0 END AS dn FROM band_pixel WHERE row BETWEEN 2 AND 33 AND col BETWEEN 2 AND 11", "band_pixel")
def clipped_pixels(spark, sf_dir):
    ring = [(6.0, 6.0), (6.0, 102.0), (36.0, 102.0), (36.0, 30.0), (12.0, 6.0)]
    return masks.clipped(view(spark, sf_dir, "band_pixel"), ring, [0.0, 3.0, 0.0, 0.0, 0.0, 3.0]).select("scene_id", "row", "col", "band", "dn")


def _scene_grids(spark, sf_dir):
    """Each scene's own georeference and UTM zone."""
    g = view(spark, sf_dir, "scene_grid").distinct()
    return g.select("scene_id", F.array("x0", F.lit(3.0), F.lit(0.0), "y0", F.lit(0.0), F.lit(3.0)).alias("georef"), "epsg")


@query(
    ", g AS (SELECT DISTINCT * FROM scene_grid), w AS (SELECT b.*, x0 + (col + 0.5) * 3 AS x, y0 + (row + 0.5) * 3 AS y, x0, y0 FROM band_pixel b JOIN g USING (scene_id))"
    " SELECT scene_id, row, col, band, CASE WHEN x - 6 < y AND NOT (x > 9 AND x < 18 AND y > 60 AND y < 90) THEN dn ELSE 0 END AS dn FROM w WHERE row BETWEEN floor((6 - y0) / 3) AND ceil((102 - y0) / 3) - 1 AND col BETWEEN floor((6 - x0) / 3) AND ceil((36 - x0) / 3) - 1",
    "band_pixel",
    "scene_grid",
)
def clipped_scenes(spark, sf_dir):
    # a region with a hole, and a georeference for each scene
    region = [[(6.0, 6.0), (6.0, 102.0), (36.0, 102.0), (36.0, 30.0), (12.0, 6.0)], [(9.0, 60.0), (18.0, 60.0), (18.0, 90.0), (9.0, 90.0)]]
    return masks.clipped(view(spark, sf_dir, "band_pixel"), region, _scene_grids(spark, sf_dir)).select("scene_id", "row", "col", "band", "dn")


def _east_grids(spark, sf_dir):
    """The scenes' grids where their zones have land: moved to the zones' coordinates."""
    return _scene_grids(spark, sf_dir).withColumn("georef", F.transform("georef", lambda v, i: v + F.when(i == 0, EAST).when(i == 3, NORTH).otherwise(0.0)))


def _reference_lines(spark, sf_dir):
    """The reference line as longitude and latitude, once in each zone that scenes lie in."""
    zones = _scene_grids(spark, sf_dir).select("epsg").distinct()
    v = view(spark, sf_dir, "reference_vertex").crossJoin(F.broadcast(zones))  # two zones
    v = geo.with_lonlat(v.withColumns({"x": F.col("x") + EAST, "y": F.col("y") + NORTH}), "x", "y", "epsg")
    return v.select(F.concat_ws("/", "line_id", "epsg").alias("line_id"), "seq", "lon", "lat")


@query(
    ", s AS (SELECT x AS ax, y AS ay, lead(x) OVER (ORDER BY seq) AS bx, lead(y) OVER (ORDER BY seq) AS ay2 FROM reference_vertex), l AS (SELECT ax, ay, bx, ay2 AS by_ FROM s WHERE bx IS NOT NULL),"
    " p AS (SELECT scene_id, row, col, x0 + (col + 0.5) * 3 AS px, y0 + (row + 0.5) * 3 AS py FROM label_pixel JOIN (SELECT DISTINCT scene_id, x0, y0 FROM scene_grid) g USING (scene_id)),"
    " u AS (SELECT *, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / ((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)))) AS t FROM p JOIN l ON ax < px + 150)"
    " SELECT DISTINCT scene_id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col FROM u WHERE power(px - ax - t * (bx - ax), 2) + power(py - ay - t * (by_ - ay), 2) <= 1600",
    "label_pixel",
    "scene_grid",
    "reference_vertex",
)
def scene_reference_buffer(spark, sf_dir):
    # the line in each scene's own zone and grid, on the pixels that the scene has
    pixels = view(spark, sf_dir, "label_pixel").select("scene_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))
    near = reference.line_buffer(_reference_lines(spark, sf_dir), _east_grids(spark, sf_dir), reference.tiles_of(pixels, 16), 40, tile=16)
    return near.join(pixels, ["scene_id", "row", "col"], "left_semi")


@query()
def projected_shorelines(spark, sf_dir):
    # from labels to dated lines in one projection, each scene by its own georeference and zone, near the reference line
    pixels, grids = view(spark, sf_dir, "label_pixel"), _scene_grids(spark, sf_dir)
    udm = masks.without_specks(view(spark, sf_dir, "udm_pixel").withColumn("cloud", masks.cloud_or_shadow()).withColumn("shadow", F.lit(False)), "cloud", 40)
    east = _east_grids(spark, sf_dir)
    dates = grids.select("scene_id", F.date_add(F.lit("2023-01-01").cast("date"), F.col("scene_id")).alias("date"))
    return contours.shorelines(pixels, udm, east, dates=dates, least_patch=100, least_length=30, nodata_dist=9, cloud_dist=6, epsg=ZONE, reference=_reference_lines(spark, sf_dir), reference_dist=60)


_JOB = (
    ", f AS (SELECT scene_id, row, col, cloud OR shadow AS cloud FROM udm_pixel)"
    + _without_specks_sql(40)
    + ", good AS (SELECT im_paths AS scene_id FROM classifier_logit WHERE logit > 0), place AS (SELECT DISTINCT scene_id, x0 AS left_, y0 AS low_, epsg FROM scene_grid),"
    " flag AS (SELECT scene_id, row, col, label > 1 AS land, keep.cloud, nodata FROM label_pixel JOIN good USING (scene_id) JOIN keep USING (scene_id, row, col) JOIN (SELECT scene_id, row, col, nodata FROM udm_pixel) u USING (scene_id, row, col)),"
    " p_land AS (SELECT scene_id, row, col FROM flag WHERE land)"
    + _patches_sql("_land")
    + ", near AS (SELECT * FROM (SELECT x AS ax, y AS ay, lead(x) OVER (ORDER BY seq) AS bx, lead(y) OVER (ORDER BY seq) AS cy FROM reference_vertex) WHERE bx IS NOT NULL),"
    " centre AS (SELECT scene_id, row, col, left_ + (col + 0.5) * 3 AS px, low_ + (row + 0.5) * 3 AS py FROM flag JOIN place USING (scene_id) WHERE NOT cloud AND NOT nodata),"
    " foot AS (SELECT *, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (cy - ay)) / ((bx - ax) * (bx - ax) + (cy - ay) * (cy - ay)))) AS u FROM centre JOIN near ON ax < px + 250),"
    " seen AS (SELECT DISTINCT scene_id, row, col FROM foot WHERE power(px - ax - u * (bx - ax), 2) + power(py - ay - u * (cy - ay), 2) <= 3600),"
    " v AS (SELECT scene_id, row, col, CASE WHEN size >= 100 THEN 1 ELSE 0 END AS high FROM seen LEFT JOIN patch_land USING (scene_id, row, col)),"
    " g AS (SELECT scene_id, row - i AS row, col - j AS col, high * (1 + 3 * i) * (1 + j) AS k FROM v, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(i, j)),"
    ' cells AS (SELECT scene_id, row, col, CAST(sum(k) AS INT) AS "case" FROM g GROUP BY scene_id, row, col HAVING count(*) = 4)'
    + _chains_sql(", line AS (SELECT scene_id, hr * 4294967296 + hc AS contour_id, seq, c * 1.5 AS x, r * 1.5 AS y FROM walk)")
    + _long_sql("long", "line", 30)
    + ", far AS (SELECT * FROM long WHERE NOT EXISTS (SELECT 1 FROM flag WHERE flag.scene_id = long.scene_id AND power(col * 3 - x, 2) + power(row * 3 - y, 2) < CASE WHEN nodata THEN 81 WHEN cloud THEN 36 ELSE 0 END))"
    + _long_sql("done", "far", 30)
    # scenes of the other zone are far from the transects, but their dates count
    + ", shoreline_point AS (SELECT CAST('2023-01-01' AS DATE) + CAST(scene_id AS INT) AS date, left_ + x + (CASE WHEN epsg = 32618 THEN 0 ELSE 1000000 END) AS x, low_ + y AS y FROM done JOIN place USING (scene_id)), turned AS (SELECT transect_id, y0 AS x0, x0 / 10 AS y0, y1 AS x1, x1 / 10 AS y1 FROM transect)"
    + _STATS.replace("JOIN transect", "JOIN turned")
    + _MODE
    + _SERIES
    + f"SELECT date AS dates, x1 + {EAST} AS x, y1 + {NORTH} AS y, transect_id, round(cross_distance, 4) AS cross_distance, round(shore_x + {EAST}, 4) AS shore_x, round(shore_y + {NORTH}, 4) AS shore_y FROM (SELECT *, {_ON} FROM kept JOIN turned USING (transect_id))"
)


@query(_JOB, "label_pixel", "udm_pixel", "reference_vertex", "scene_grid", "classifier_logit", "transect")
def scenes_to_series(spark, sf_dir):
    # the whole job: good scenes with their masks, to lines near the reference in one projection, to distances by transect and date
    good = quality.verdicts(view(spark, sf_dir, "classifier_logit")).where("im_classes = 'good'").select(F.col("im_paths").alias("scene_id"))
    pixels = view(spark, sf_dir, "label_pixel").join(good, "scene_id", "left_semi")
    udm = masks.without_specks(view(spark, sf_dir, "udm_pixel").withColumn("cloud", masks.cloud_or_shadow()).withColumn("shadow", F.lit(False)), "cloud", 40)
    east = _east_grids(spark, sf_dir)
    dates = east.select("scene_id", F.date_add(F.lit("2023-01-01").cast("date"), F.col("scene_id")).alias("date"))
    lines = contours.shorelines(pixels, udm, east, dates=dates, least_patch=100, least_length=30, nodata_dist=9, cloud_dist=6, epsg=ZONE, reference=_reference_lines(spark, sf_dir), reference_dist=60)
    # the fixture's transects, turned so that they cross these scenes' shorelines
    turned = {"x0": F.col("y0") + EAST, "y0": F.col("x0") / 10 + NORTH, "x1": F.col("y1") + EAST, "y1": F.col("x1") / 10 + NORTH}
    series = transects.time_series(lines.select("date", "x", "y"), view(spark, sf_dir, "transect").withColumns(turned))
    return rounded(series, 4, "cross_distance", "shore_x", "shore_y")


@query("SELECT date, x, y, true AS back FROM shoreline_point", "shoreline_point")
def utm_roundtrip(spark, sf_dir):
    # the shore runs on from zone to zone, eastwards: a zone has 200 km of it, on both sides of its middle
    zones = F.floor(F.col("x") / STRETCH)
    p = view(spark, sf_dir, "shoreline_point").withColumn("zone", (F.pmod(zones + ZONE - 32601, F.lit(60)) + 32601).cast("int"))
    p = geo.with_lonlat(p.withColumns({"east": F.col("x") - zones * STRETCH + EAST, "north": F.col("y") + NORTH}), "east", "north", "zone")
    p = geo.with_utm(p, "lon", "lat", "zone", "_x", "_y")
    close = (F.abs(F.col("_x") - F.col("east")) < 1e-3) & (F.abs(F.col("_y") - F.col("north")) < 1e-3) & (geo.utm_epsg("lon", "lat") == F.col("zone"))
    return p.select("date", "x", "y", close.alias("back"))
