"""Sinks: GeoJSON lines, CSV and JSON of shorelines, points and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.staging import staged
from strandline.operators.quality import folder
from strandline.operators.transects import wide_blocks

SERIES = ["dates", "x", "y", "transect_id", "cross_distance", "shore_x", "shore_y"]


def _feature(kind: str, coordinates: Column, **properties: Column) -> Column:
    geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*[v.alias(k) for k, v in properties.items()]).alias("properties"), geometry.alias("geometry")))


def _stamp(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def line_features(vertices: DataFrame) -> DataFrame:
    """date, value: a GeoJSON feature a line (date, line, seq, x, y), in order of dates."""
    pts = F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.array(p.x, p.y))
    lines = vertices.groupBy("date", "line").agg(pts.alias("c"))
    return lines.select("date", _feature("LineString", F.col("c"), date=_stamp("date")).alias("value")).orderBy("date")


def point_features(series: DataFrame) -> DataFrame:
    """dates, value: a GeoJSON point for each position of a long series."""
    at = F.array("shore_x", "shore_y")
    return series.select("dates", _feature("Point", at, dates=_stamp("dates"), transect_id=F.col("transect_id"), cross_distance=F.col("cross_distance")).alias("value"))


def write_geojson(features: DataFrame, path: str) -> None:
    """One feature a line (newline-delimited GeoJSON), so that writing and reading are both split."""
    features.select("value").write.text(path)


def write_wide_csv(series: DataFrame, path: str) -> None:
    """The wide table as CSV, a line a date, in order; above BLOCK transects a file for each block of columns, under
    ``block=<number>``, each with its own header and all dates."""
    blocks = staged(wide_blocks(series))
    names = F.transform("ids", lambda c: F.when(c.rlike('[",]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c))
    heads = blocks.groupBy("block").agg(F.first("transect_ids").alias("ids")).select("block", F.lit(0).alias("line"), F.lit("dates").alias("dates"), names.alias("fields"))
    values = F.transform("cross_distances", lambda v: F.coalesce(v.cast("string"), F.lit("")))
    rows = blocks.select("block", F.lit(1).alias("line"), F.col("dates").cast("string").alias("dates"), values.alias("fields"))
    lines = heads.unionByName(rows).repartition("block").sortWithinPartitions("block", "line", "dates")
    lines = lines.select("block", F.concat_ws(",", "dates", F.array_join("fields", ",")).alias("value"))
    if blocks.agg(F.max("block")).first()[0]:
        lines.write.partitionBy("block").text(path)
    else:
        lines.select("value").write.text(path)


def write_long_csv(series: DataFrame, path: str) -> None:
    series.select(*SERIES).write.csv(path, header=True)


def write_dropped_csv(dropped: DataFrame, path: str) -> None:
    dropped.write.csv(path, header=True)


def distances(series: DataFrame) -> DataFrame:
    """transect_id, dates (ISO text), cross_distance: arrays in order of dates."""
    own = F.array_sort(F.collect_list(F.struct("dates", "cross_distance")))
    g = series.groupBy("transect_id").agg(own.alias("s"))
    iso = F.transform("s", lambda v: F.date_format(v.dates, "yyyy-MM-dd'T'HH:mm:ss"))
    return g.select("transect_id", iso.alias("dates"), F.transform("s", lambda v: v.cross_distance).alias("cross_distance"))


def write_distances_json(series: DataFrame, path: str) -> None:
    distances(series).write.json(path)


def write_by_verdict(images: DataFrame, path: str) -> None:
    """Under ``good/`` what is good, under ``bad/`` anything else, null too."""
    images.withColumn("verdict", folder()).write.partitionBy("verdict").parquet(path)


def sidecars_by_verdict(images: DataFrame, files: DataFrame) -> DataFrame:
    """path, verdict for every file that has a verdict's scene id (its first four name tokens)."""
    sid = lambda c: F.array_join(F.slice(F.split(c, "_"), 1, 4), "_")
    v = images.select(sid(F.element_at(F.split("im_paths", "/"), -1)).alias("scene_id"), folder().alias("verdict")).distinct()
    return files.withColumn("scene_id", sid(F.col("name"))).join(v, "scene_id").select("path", "verdict")
