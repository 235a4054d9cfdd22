"""Domain views over the driver's tables: the same expressions as Spark columns and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: name -> (table or view, expressions)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "transect": (
        "supplier",
        [
            "concat('t', CAST(s_suppkey AS STRING)) AS transect_id",
            "CAST(100 * s_suppkey AS DOUBLE) AS x0",
            "CAST(0 AS DOUBLE) AS y0",
            "CAST(100 * s_suppkey + 30 * ((s_suppkey % 3) - 1) AS DOUBLE) AS x1",
            "CAST(300 AS DOUBLE) AS y1",
        ],
    ),
    "shoreline_point": (
        "lineitem",
        [
            "CAST(date_trunc('month', l_shipdate) AS DATE) AS date",
            "CAST(100 * l_suppkey + (l_partkey * 7 + l_linenumber * 13) % 101 - 50 AS DOUBLE) AS x",
            "CASE WHEN l_partkey % 97 = 0 THEN 2000 + l_quantity WHEN l_partkey % 89 = 0 THEN CAST(-150 AS DOUBLE)"
            " ELSE 80 + l_quantity * CAST(CASE l_suppkey % 3 WHEN 0 THEN 0.4 WHEN 1 THEN 0.7 ELSE 1.4 END AS DOUBLE) END AS y",
        ],
    ),
    "scene_item": (
        "events",
        [
            "event_id AS scene_id",
            "event_id AS seq",
            "ts AS acquired",
            "round(value / 500, 4) AS cloud_cover",
            "user_id % 8 AS satellite_id",
            "event_type AS instrument",
            "props",
            "CAST(event_id * 37 % 100 AS DOUBLE) / 100 AS minx",
            "CAST(event_id * 53 % 100 AS DOUBLE) / 100 AS miny",
            "CAST(event_id * 37 % 100 + 50 AS DOUBLE) / 100 AS maxx",
            "CAST(event_id * 53 % 100 + 50 AS DOUBLE) / 100 AS maxy",
        ],
    ),
    "classifier_logit": ("events", ["event_id AS im_paths", "(value - 50) / 25 AS logit", "event_id % 3 = 0 AS already_scored"]),
    "scene_order": (
        "orders",
        [
            "o_orderkey AS order_id",
            "concat('site', CAST(o_custkey % 10 AS STRING), CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1"
            " THEN concat('_batch_', CAST(o_orderkey % 5 + 1 AS STRING)) ELSE '_x' END) AS name",
            "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'running' ELSE 'failed' END AS state",
            "CAST(o_orderdate AS DATE) AS changed",
            "o_custkey % 100 AS site",
        ],
    ),
    "region_part": (
        "supplier",
        [
            "s_suppkey % 10 AS region_id",
            "s_suppkey AS part",
            "CAST(s_suppkey * 37 % 100 AS DOUBLE) / 80 AS cx",
            "CAST(s_suppkey * 53 % 97 AS DOUBLE) / 80 AS cy",
            "CAST(5 + s_suppkey % 7 AS DOUBLE) / 100 AS a",
            "CAST(4 + s_suppkey % 5 AS DOUBLE) / 100 AS b",
            "s_suppkey % 4 = 0 AS holed",
        ],
    ),
    "reference_vertex": (
        "supplier",
        ["CAST(0 AS INT) AS line_id", "CAST(s_suppkey AS INT) AS seq", "CAST(100 * s_suppkey AS DOUBLE) AS x", "CAST(90 + 10 * (s_suppkey % 3) AS DOUBLE) AS y"],
    ),
    "raster_file": (
        "part",
        [
            "p_partkey AS file_id",
            "CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_partkey % 100 AS DOUBLE) END AS west",
            "CAST(p_partkey % 100 + 100 * p_size AS DOUBLE) AS east",
            "CAST(p_partkey % 70 AS DOUBLE) AS south",
            "CAST(p_partkey % 70 + 120 * p_size AS DOUBLE) AS north",
        ],
    ),
    "order_spec": (
        "orders",
        [
            "o_orderkey AS order_id",
            "CASE WHEN o_orderkey % 11 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS start_date",
            "CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 1 AS INT) AS STRING) AS end_date",
            "o_totalprice / 400000 AS cloud_cover",
            "CAST(o_custkey % 13 AS DOUBLE) / 10 AS min_area_percentage",
            "CASE WHEN o_orderkey % 4 = 0 THEN 'roi.shp' ELSE 'roi.geojson' END AS roi_path",
        ],
    ),
    "scene_file": (
        "events",
        [
            "event_id AS file_id",
            "concat('/orders/', CAST(user_id AS STRING), CASE WHEN event_id % 2 = 0 THEN '/PSScene' ELSE '' END) AS folder",
            "concat('2024010', CAST(event_id % 9 + 1 AS STRING), '_', lpad(CAST(event_id % 24 AS STRING), 2, '0'), '3015_', CAST(user_id AS STRING), '_', CAST(event_id AS STRING)) AS base",
            "CASE event_id % 4 WHEN 0 THEN '_3B_x.tif' WHEN 1 THEN '_3B_udm.tif' WHEN 2 THEN '_3B_x.xml' ELSE '_3B_x.json' END AS ending",
        ],
    ),
    "landsat_file": (
        "events",
        [
            "concat('L', CAST(5 + user_id % 5 AS STRING)) AS sensor",
            "CASE WHEN event_id % 3 = 0 OR (event_id % 3 = 2 AND user_id % 5 = 4) THEN 'meta' WHEN event_id % 3 = 1 THEN 'ms' ELSE 'mask' END AS kind",
        ],
    ),
    "contour_vertex": (
        "orders",
        [
            "o_custkey AS contour",
            "o_orderkey AS seq",
            "CASE WHEN o_orderkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice / 1000 END AS x",
            "CASE WHEN o_orderkey % 44 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(o_orderkey % 100 AS DOUBLE) END AS y",
        ],
    ),
    "region_side": ("customer", ["c_custkey AS region_id", "c_acctbal AS w", "CAST(c_custkey % 40 AS DOUBLE) AS h"]),
    "order_tool": (
        "orders",
        ["o_orderkey AS order_id", "CASE o_orderkey % 3 WHEN 0 THEN ' Clip' WHEN 1 THEN 'TOAR ' ELSE 'coregister' END AS tool", "o_orderpriority AS other"],
    ),
    "order_file": (
        "lineitem",
        [
            "l_orderkey AS order_id",
            "concat('/o/', CAST(l_orderkey AS STRING), CASE WHEN l_partkey % 9 = 0 THEN '/other/' ELSE '/PSScene/' END, CAST(l_linenumber AS STRING),"
            " CASE l_linenumber % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.XML' ELSE '.json' END) AS path",
        ],
    ),
    "band_pixel": (
        "cell",
        [
            "CAST(floor(vec_id / 64.0) AS INT) AS scene_id",
            "CAST(vec_id % 64 AS INT) AS row",
            "CAST(floor(pos / 4.0) AS INT) AS col",
            "CAST(pos % 4 + 1 AS INT) AS band",
            "CAST(round((v + 1) * 4000) AS INT) AS dn",
        ],
    ),
    "class_score": (
        "cell",
        [
            "CAST(floor(vec_id / 64.0) AS INT) AS scene_id",
            "CAST(vec_id % 64 AS INT) AS row",
            "CAST(floor(pos / 4.0) AS INT) AS col",
            "CAST(pos % 4 AS INT) AS class_idx",
            "v AS score",
        ],
    ),
    "label_pixel": (
        "cell",
        [
            "CAST(floor(vec_id / 64.0) AS INT) AS scene_id",
            "CAST(vec_id % 64 AS INT) AS row",
            "CAST(pos AS INT) AS col",
            "CAST(CASE WHEN pos + 20 * v < 28 THEN 0 WHEN pos + 20 * v < 32 THEN 1 WHEN pos + 20 * v < 36 THEN 2 ELSE 3 END AS INT) AS label",
        ],
    ),
    "scene_grid": (
        "embeddings",
        [
            "CAST(floor(vec_id / 64.0) AS INT) AS scene_id",
            "CAST(3 * (floor(vec_id / 64.0) % 3) AS DOUBLE) AS x0",
            "CAST(3 * (floor(vec_id / 64.0) % 2) AS DOUBLE) AS y0",
            "CAST(32617 + floor(vec_id / 64.0) % 2 AS INT) AS epsg",
        ],
    ),
    "udm_pixel": (
        "cell",
        [
            "CAST(floor(vec_id / 64.0) AS INT) AS scene_id",
            "CAST(vec_id % 64 AS INT) AS row",
            "CAST(pos AS INT) AS col",
            "CAST(round((v + 1) * 4000) AS INT) % 37 = 0 AS shadow",
            "CAST(round((v + 1) * 4000) AS INT) % 41 = 0 AS cloud",
            "pos < 2 AS nodata",
            "CAST(round((v + 1) * 4000) AS INT) % 256 AS qa",
            "v * 40 AS elevation",
        ],
    ),
}

_SQL_ONLY = {
    "cell": "SELECT vec_id, CAST(unnest(range(len(embedding))) AS BIGINT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings",
    "date_cloud": "SELECT CAST(o_orderdate AS DATE) AS date_acquired, round(min(o_totalprice) / max_p, 3) AS cloud_cover FROM orders"
    " CROSS JOIN (SELECT max(o_totalprice) AS max_p FROM orders) m GROUP BY CAST(o_orderdate AS DATE), max_p",
    "date_meta": "SELECT CAST(l_shipdate AS DATE) AS date_acquired, round(4 + 200 * avg(l_discount), 3) AS acc_georef FROM lineitem WHERE l_quantity > 10 GROUP BY CAST(l_shipdate AS DATE)",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    if name == "cell":
        e = table("embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
        return e.select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("v"))
    if name == "date_cloud":
        orders = table("orders")
        low = orders.groupBy(F.col("o_orderdate").cast("date").alias("date_acquired")).agg(F.min("o_totalprice").alias("p"))
        top = orders.agg(F.max("o_totalprice").alias("m"))
        return low.crossJoin(F.broadcast(top)).select("date_acquired", F.round(F.col("p") / F.col("m"), 3).alias("cloud_cover"))
    if name == "date_meta":
        items = table("lineitem").where("l_quantity > 10").groupBy(F.col("l_shipdate").cast("date").alias("date_acquired"))
        return items.agg(F.round(4 + 200 * F.avg("l_discount"), 3).alias("acc_georef"))
    base, expressions = VIEWS[name]
    return (view(spark, sf_dir, base) if base == "cell" else table(base)).selectExpr(*expressions)


def ctes(*names: str) -> str:
    """``WITH`` clause that defines views for DuckDB."""
    out: dict[str, str] = {}
    for n in names:
        if n in _SQL_ONLY:
            out[n] = _SQL_ONLY[n]
            continue
        base, expressions = VIEWS[n]
        if base in _SQL_ONLY:
            out[base] = _SQL_ONLY[base]
        out[n] = f"SELECT {', '.join(expressions)} FROM {base}"
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in out.items()) + " "
