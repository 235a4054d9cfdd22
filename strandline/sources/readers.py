"""Readers. Every one returns a DataFrame of a fixed schema; nothing is opened outside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = "type string, features array<struct<type:string, properties:map<string,string>, geometry:struct<type:string, coordinates:string>>>"

SCENE = """id string, type string, geometry struct<type:string, coordinates:array<array<array<double>>>>,
properties struct<acquired:timestamp, anomalous_pixels:double, clear_confidence_percent:double, clear_percent:double,
cloud_cover:double, cloud_percent:double, ground_control:boolean, gsd:double, heavy_haze_percent:double, instrument:string,
item_type:string, light_haze_percent:double, pixel_resolution:double, provider:string, published:timestamp,
publishing_stage:string, quality_category:string, satellite_azimuth:double, satellite_id:string, shadow_percent:double,
snow_ice_percent:double, strip_id:string, sun_azimuth:double, sun_elevation:double, updated:timestamp, view_angle:double,
visible_confidence_percent:double, visible_percent:double>"""

SHORELINE_JSON = "dates array<string>, shorelines array<array<array<double>>>"

#: Georeference accuracy of a metadata file that does not state one.
DEFAULT_ACCURACY = 12.0


def features(spark: SparkSession, path: str, feature_id: str | None = None) -> DataFrame:
    """feature, properties, kind, coordinates (JSON text) of GeoJSON features.

    Where features have a ``type`` property, those of type ``roi`` are kept, and of them, if ``feature_id`` is
    given, that id; without such a property all are kept, whatever the id.
    """
    f = spark.read.option("multiLine", True).schema(FEATURES).json(path).select(F.input_file_name().alias("path"), F.posexplode("features").alias("feature", "f"))
    f = f.select("path", "feature", "f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))
    typed = F.map_contains_key("properties", F.lit("type"))
    keep = F.col("properties")["type"] == "roi"
    if feature_id:
        keep = keep & (F.col("properties")["id"] == feature_id)
    return f.where(~F.coalesce(typed, F.lit(False)) | keep)


def polygon_rings(found: DataFrame) -> DataFrame:
    """feature, part, ring (array of (x, y)): outer rings of polygons and multi-polygons."""
    one = F.from_json("coordinates", "array<array<array<double>>>")
    many = F.from_json("coordinates", "array<array<array<array<double>>>>")
    rings = F.when(F.col("kind") == "Polygon", F.array(one[0])).when(F.col("kind") == "MultiPolygon", F.transform(many, lambda p: p[0]))
    out = found.select("*", F.posexplode(rings).alias("part", "_r")).withColumn("ring", _points(F.col("_r")))
    return out.drop("_r", "coordinates")


def line_vertices(found: DataFrame) -> DataFrame:
    """feature, properties, part, seq, x, y, z: vertices of lines and multi-lines; z is 0 where there is none."""
    one = F.from_json("coordinates", "array<array<double>>")
    many = F.from_json("coordinates", "array<array<array<double>>>")
    lines = F.when(F.col("kind") == "LineString", F.array(one)).when(F.col("kind") == "MultiLineString", many)
    out = found.select("feature", "properties", F.posexplode(lines).alias("part", "l"))
    out = out.select("feature", "properties", "part", F.posexplode("l").alias("seq", "p"))
    return out.select("feature", "properties", "part", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"), F.coalesce(F.get("p", F.lit(2)), F.lit(0.0)).alias("z"))


def point_vertices(found: DataFrame) -> DataFrame:
    """feature, properties, seq, x, y of points and multi-points."""
    one, many = F.from_json("coordinates", "array<double>"), F.from_json("coordinates", "array<array<double>>")
    pts = F.when(F.col("kind") == "Point", F.array(one)).when(F.col("kind") == "MultiPoint", many)
    out = found.select("feature", "properties", F.posexplode(pts).alias("seq", "p"))
    return out.select("feature", "properties", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def transect_vertices(found: DataFrame) -> DataFrame:
    """transect_id (text; the feature's number where none has an id), part, seq, x, y."""
    v = line_vertices(found)
    return v.select(F.coalesce(F.col("properties")["id"], F.col("feature").cast("string")).alias("transect_id"), "part", "seq", "x", "y")


def _points(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def scene_metadata(spark: SparkSession, path: str, flat: bool = True) -> DataFrame:
    """Scene records from JSON; flat: scene_id, acquired, cloud_cover, satellite_id, instrument, ring and its box."""
    raw = spark.read.option("multiLine", True).schema(SCENE).json(path)
    if not flat:
        return raw
    ring = _points(F.col("geometry.coordinates")[0])
    p = raw.select(F.col("id").alias("scene_id"), *[F.col(f"properties.{c}").alias(c) for c in ("acquired", "cloud_cover", "satellite_id", "instrument")], ring.alias("ring"))
    xs, ys = F.transform("ring", lambda q: q.x), F.transform("ring", lambda q: q.y)
    return p.withColumns({"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)})


def reflectance_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """path, instrument, band, coeff from scene metadata in XML (bands 1 to 4)."""
    band = "`ps:bandNumber` int, `ps:reflectanceCoefficient` double"
    schema = f"""`eop:using` struct<`eop:EarthObservationEquipment`:struct<`eop:platform`:struct<`eop:Platform`:struct<`eop:shortName`:string>>,
    `eop:instrument`:struct<`eop:Instrument`:struct<`eop:shortName`:string>>>>,
    `gml:resultOf` struct<`ps:EarthObservationResult`:struct<`ps:bandSpecificMetadata`:array<struct<{band.replace("` ", "`:")}>>>>,
    `gml:using` struct<`eop:EarthObservationEquipment`:struct<`eop:instrument`:struct<`eop:Instrument`:struct<`eop:shortName`:string>>>>"""
    raw = spark.read.format("xml").option("rowTag", "ps:EarthObservation").schema(schema).load(path)
    name = "`eop:EarthObservationEquipment`.`eop:instrument`.`eop:Instrument`.`eop:shortName`"
    rows = raw.select(F.input_file_name().alias("path"), F.coalesce(F.col(f"`gml:using`.{name}"), F.col(f"`eop:using`.{name}")).alias("instrument"), F.explode("`gml:resultOf`.`ps:EarthObservationResult`.`ps:bandSpecificMetadata`").alias("b"))
    return rows.select("path", "instrument", F.col("b.`ps:bandNumber`").alias("band"), F.col("b.`ps:reflectanceCoefficient`").alias("coeff")).where("band between 1 and 4")


def georef_accuracy(spark: SparkSession, path: str) -> DataFrame:
    """path, acc_georef: the second word of a file's first line that begins so; 12 where there is none."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), "value")
    word = F.try_element_at(F.split(F.trim("value"), r"\s+"), F.lit(2))
    mine = F.when(F.col("value").startswith("acc_georef"), F.struct("at", word.try_cast("double").alias("v")))
    return lines.groupBy("path").agg(F.min(mine).alias("m")).select("path", F.coalesce("m.v", F.lit(DEFAULT_ACCURACY)).alias("acc_georef"))


def model_classes(spark: SparkSession, path: str, key: str = "CLASSES") -> DataFrame:
    """class_idx, class_name from a model card; ``key`` is where its class map stands."""
    text = spark.read.option("wholetext", True).text(path).select(F.from_json(F.get_json_object("value", f"$.{key}"), "map<string,string>").alias("m"))
    return text.select(F.explode("m").alias("k", "class_name")).select(F.col("k").cast("int").alias("class_idx"), "class_name")


def catalogue(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, name, length of all files under a folder, however deep; contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    r = r.option("pathGlobFilter", pattern) if pattern else r
    return r.load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def matching_files(files: DataFrame, patterns: list[str]) -> DataFrame:
    """A row for each pattern (glob over the name) that a file matches: a file may come twice."""
    rx = [F.struct(F.lit(p).alias("pattern"), F.lit("^" + "".join(".*" if c == "*" else "." if c == "?" else f"\\{c}" if not c.isalnum() and c != "_" else c for c in p) + "$").alias("rx")) for p in dict.fromkeys(patterns)]
    return files.withColumn("_p", F.explode(F.array(*rx))).where(F.regexp_like("name", F.col("_p.rx"))).withColumn("pattern", F.col("_p.pattern")).drop("_p")


def file_by_regex(files: DataFrame, pattern: str) -> DataFrame:
    """One row: the least path whose name matches, letter case aside; reading it raises an error if there is none."""
    hit = files.where(F.col("name").rlike(f"(?i){pattern}")).agg(F.min("path").alias("path"))
    return hit.select(F.coalesce("path", F.raise_error(F.lit(f"no file matches {pattern}")).cast("string")).alias("path"))


def with_sidecar(scenes: DataFrame, files: DataFrame, suffix: str, out: str = "sidecar", required: bool = False) -> DataFrame:
    """scenes (folder, base) with the least path ``folder/base*suffix``, null (or the scene dropped) if none."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    f = files.where(F.col("name").endswith(suffix)).select(folder.alias("folder"), "name", "path")
    f = f.withColumn("base", F.split_part("name", F.lit("_3B"), F.lit(1))).groupBy("folder", "base").agg(F.min("path").alias(out))
    return scenes.join(f, ["folder", "base"], "inner" if required else "left")


def tiles(pixels: DataFrame, size: int = 256) -> DataFrame:
    """Pixels with tile_row and tile_col, dealt by (scene_id, tile), ready to be written by scene."""
    t = pixels.withColumn("tile_row", F.floor(F.col("row") / size).cast("int")).withColumn("tile_col", F.floor(F.col("col") / size).cast("int"))
    return t.repartition("scene_id", "tile_row", "tile_col")


def shorelines_json(spark: SparkSession, path: str) -> DataFrame:
    """date, seq, x, y from {"dates": [...], "shorelines": [[[x, y], ...], ...]}; a date without points has one row of nulls."""
    raw = spark.read.option("multiLine", True).schema(SHORELINE_JSON).json(path)
    pairs = raw.select(F.explode(F.arrays_zip("dates", "shorelines")).alias("z")).select(F.to_timestamp("z.dates").alias("date"), F.posexplode_outer("z.shorelines").alias("seq", "p"))
    return pairs.select("date", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """dates (text), transect_id, cross_distance, without nulls, of the files that writers.write_wide_csv() writes: each
    block's header is joined to its lines, so any number of columns is read."""
    lines = spark.read.text(path)
    block = F.col("block") if "block" in lines.columns else F.lit(0)
    field = F.regexp_extract_all("value", F.lit(r'(?:^|,)("(?:[^"]|"")*+"|[^,]*)'), F.lit(1))
    lines = lines.select(block.alias("block"), field.alias("f")).select("block", F.col("f")[0].alias("dates"), F.slice("f", 2, F.size("f") - 1).alias("f"))
    plain = lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    heads = lines.where("dates = 'dates'").select("block", F.transform("f", plain).alias("ids"))
    cell = F.explode(F.arrays_zip(F.col("ids").alias("transect_id"), F.col("f").alias("value")))
    cells = lines.where("dates <> 'dates'").join(heads, "block").select("dates", cell.alias("c")).where("c.value <> ''")
    return cells.select("dates", "c.transect_id", F.col("c.value").cast("double").alias("cross_distance"))
