"""Scene catalogue: search, selection, ordering and batching, and order state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.functions.names import BATCH_SIZE, acquired_date, batch_name, order_name_matches, property_or
from strandline.operators import overlay
from strandline.operators.clip import clipped_area, plain_area, rings_of

BOX = ("minx", "miny", "maxx", "maxy")


def search(items: DataFrame, box: tuple, start, end, cloud_cover: float = 0.99, assets: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Scenes whose box meets ``box``, acquired strictly between start and end, with at most that cloud cover.

    Plain comparisons, so they are pushed to the scan. ``limit`` keeps that many, the earliest first.
    """
    found = items.where(geo.boxes_meet(BOX, box) & (F.col("acquired") > F.lit(start)) & (F.col("acquired") < F.lit(end)) & (F.col("cloud_cover") <= cloud_cover))
    if assets:
        found = found.where(F.arrays_overlap("assets", F.array(*[F.lit(a) for a in assets])))
    return found if limit is None else found.orderBy("acquired", "scene_id").limit(limit)


def in_months(items: DataFrame, months: list[str] | None) -> DataFrame:
    """Scenes of the given months ("01" to "12"); none given: all."""
    return items.where(F.date_format("acquired", "MM").isin(list(months))) if months else items


def covering(items: DataFrame, box: tuple, share: float = 0.5) -> DataFrame:
    """Scenes whose box covers strictly more than ``share`` of the region's box."""
    area = (float(box[2]) - box[0]) * (float(box[3]) - box[1])
    return items.withColumn("area", geo.box_overlap(BOX, box)).where(F.col("area") > share * area)


def polygon_coverage(items: DataFrame, region: list, share: float = 0.5) -> DataFrame:
    """The same for footprint rings (``ring``, array of (x, y)) and a region of any shape: a ring, or an outer
    ring and its holes. Footprints whose box shares too little with the region's box are told by that alone."""
    xs, ys = zip(*(p for r in rings_of(region) for p in r), strict=True)
    b = geo.ring_bounds("ring")
    shared = geo.box_overlap(tuple(b[k] for k in BOX), (min(xs), min(ys), max(xs), max(ys)))
    items = items.where(shared >= share * plain_area(region) * (1 - 1e-9))
    return items.withColumn("area", clipped_area(region)("ring")).where(F.col("area") > share * plain_area(region))


def regions_coverage(items: DataFrame, regions: DataFrame, share: float = 0.5, size: float = 0.25) -> DataFrame:
    """The same for a table of regions (region_id, part, ring) of any number of parts, all at once: a footprint's area
    in their union, overlaps once, against ``share`` of the sum of their areas."""
    total = F.broadcast(overlay.total_area(regions))
    found = overlay.covered_area(items, regions, size).crossJoin(total)
    return found.where(F.col("area") > share * F.col("total")).drop("total")


def big_enough(files: DataFrame, expected_km2: float, threshold: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(files whose bounds hold at least that share of the expected area, the others); without bounds: others."""
    ok = F.coalesce((F.col("right") - F.col("left")) * (F.col("top") - F.col("bottom")) >= expected_km2 * 1e6 * threshold, F.lit(False))
    return files.where(ok), files.where(~ok)


def matching_orders(orders: DataFrame, name: str, states: list[str] | None = None) -> DataFrame:
    """Distinct order_id of orders of that name or its batches, in one of the states (success)."""
    return orders.where(order_name_matches(F.col("name"), name) & F.col("state").isin(states or ["success"])).select("order_id").distinct()


def violations(specs: DataFrame) -> DataFrame:
    """Order specifications with an array of the rules they break."""
    start, end = (F.expr(f"to_date(try_to_timestamp({c}, 'yyyy-MM-dd'))") for c in ("start_date", "end_date"))
    bad = lambda cond, name: F.when(~F.coalesce(cond, F.lit(False)), F.lit(name))
    rules = [
        bad(start.isNotNull(), "start_date is no date"),
        bad(end.isNotNull(), "end_date is no date"),
        bad(start < end, "start_date is not before end_date"),
        bad(F.col("cloud_cover").between(0, 1), "cloud_cover is not in [0, 1]"),
        bad(F.col("min_area_percentage").between(0, 1), "min_area_percentage is not in [0, 1]"),
        bad(F.col("roi_path").endswith(".geojson"), "roi_path is no .geojson"),
    ]
    if "roi_types" in specs.columns:
        rules.append(bad(F.forall("roi_types", lambda t: t == "Polygon"), "a region is no Polygon"))
    return specs.withColumn("violations", F.array_compact(F.array(*rules)))


def ids_by_date(items: DataFrame) -> DataFrame:
    """date, ids in input order (``seq``) for each acquired date."""
    own = F.transform(F.array_sort(F.collect_list(F.struct("seq", "scene_id"))), lambda x: x.scene_id)
    return items.groupBy(F.to_date("acquired").alias("date")).agg(own.alias("ids"))


def ordered_ids(items: DataFrame, months: list[str] | None = None) -> DataFrame:
    """scene_id and date, by acquired date and, inside a date, in input order."""
    return in_months(items, months).select("scene_id", "seq", F.to_date("acquired").alias("date")).orderBy("date", "seq")


def batches(items: DataFrame, base: str, size: int = BATCH_SIZE, coregister_id: str | None = None) -> DataFrame:
    """batch (from 1), name, ids, n: ids by date in chunks of ``size``, the coregistration id added to each.

    The rank over all scenes comes from ranks inside a date and a running count of dates: only the table of
    dates, a row a day, is ordered as a whole.
    """
    dated = items.select("scene_id", "seq", F.to_date("acquired").alias("date"))
    per_day = dated.groupBy("date").count()
    before = Window.orderBy(F.col("date").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.select(F.col("date").alias("d"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("date").orderBy("seq", "scene_id")
    ranked = dated.withColumn("r", F.row_number().over(inside)).join(per_day, F.col("date").eqNullSafe(F.col("d")))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("r") - 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "scene_id"))), lambda x: x.scene_id.cast("string"))
    if coregister_id is not None:
        ids = F.concat(ids, F.array(F.lit(coregister_id)))
    out = ranked.groupBy(F.expr(f"cast(rank div {size} as int) + 1").alias("batch")).agg(ids.alias("ids"))
    return out.withColumn("n", F.size("ids")).withColumn("name", batch_name(base, F.col("batch"), F.col("n")))


def least_cloud(items: DataFrame) -> DataFrame:
    """One row: scene_id of least cloud cover, the first in input order; null where none has a cover."""
    known = F.when(F.col("cloud_cover").isNotNull(), F.struct("cloud_cover", "seq"))
    return items.agg(F.min_by("scene_id", known).alias("scene_id"))


def coregister_choice(items: DataFrame, wanted: bool, user_id: str | None = None) -> DataFrame:
    """One row: the id to coregister with: "" if not wanted, the user's, else that of least cloud.

    An id that is not among the scenes raises an error when the row is read.
    """
    if not wanted:
        return items.sparkSession.sql("SELECT '' AS scene_id")
    chosen = items.sparkSession.createDataFrame([(user_id,)], "scene_id string") if user_id else least_cloud(items).select(F.col("scene_id").cast("string"))
    there = items.select(F.col("scene_id").cast("string").alias("known")).distinct()
    joined = chosen.join(there, F.col("scene_id") == F.col("known"), "left")
    error = F.raise_error(F.concat(F.lit("not among the scenes: "), F.coalesce("scene_id", F.lit("none")))).cast("string")
    return joined.select(F.when(F.col("known").isNotNull(), F.col("scene_id")).otherwise(error).alias("scene_id"))


def best_scored(cloud: DataFrame, meta: DataFrame) -> DataFrame:
    """date_acquired, cloud_cover, acc_georef, score of the best scene, the first of equals.

    score = 0.7 acc / max acc + 0.3 cover / max cover, times 0.8 under 5 % cover; a maximum of 0 adds
    nothing; dates without meta have no score and drop out.
    """
    both = cloud.join(meta, "date_acquired")
    top = both.agg(F.max("acc_georef").alias("ma"), F.max("cloud_cover").alias("mc"))
    part = lambda v, m, w: F.coalesce(w * F.col(v) / F.nullif(F.col(m), F.lit(0.0)), F.lit(0.0))
    score = part("acc_georef", "ma", 0.7) + part("cloud_cover", "mc", 0.3)
    scored = both.crossJoin(F.broadcast(top)).withColumn("score", score * F.when(F.col("cloud_cover") < 0.05, 0.8).otherwise(1.0))
    return scored.select("date_acquired", "cloud_cover", "acc_georef", "score").orderBy("score", "date_acquired").limit(1)


def best_sensor(files: DataFrame, priority: tuple[str, ...] = ("L9", "L8", "L7", "L5"), kinds: tuple[str, ...] = ("meta", "ms", "mask")) -> DataFrame:
    """The first sensor in order of priority that has files of every kind (columns sensor, kind)."""
    full = files.where(F.col("kind").isin(list(kinds))).groupBy("sensor").agg(F.count_distinct("kind").alias("n")).where(F.col("n") == len(kinds))
    place = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("sensor"))
    return full.withColumn("p", place).where("p > 0").orderBy("p").limit(1).select("sensor")


def complete_orders(paths: DataFrame, folder: str) -> DataFrame:
    """order_id, complete: files under the scene folder, with at least one each of .tif, .xml and .json."""
    p = F.col("path")
    inside = p.contains(f"/{folder}/")
    has = [F.bool_or(inside & F.lower(p).endswith(e)) for e in (".tif", ".xml", ".json")]
    return paths.groupBy("order_id").agg((has[0] & has[1] & has[2]).alias("complete"))


def nested_property(items: DataFrame, key: str, default, out: str, source: str = "properties") -> DataFrame:
    return items.withColumn(out, property_or(F.col(source), key, default))


def acquired_dates(items: DataFrame, column: str = "acquired") -> DataFrame:
    """Distinct dates of ISO time texts."""
    return items.select(acquired_date(F.col(column)).alias("date")).distinct()


def with_date_ids(items: DataFrame, dates: list) -> DataFrame:
    """ids_by_date for the dates asked for only."""
    return ids_by_date(items.where(F.to_date("acquired").isin(dates)))


def total_area(regions: DataFrame, ring: Column | str = "ring") -> DataFrame:
    """One row: area_m2 and area_km2 of all regions' rings."""
    return regions.agg(F.sum(geo.ring_area(ring)).alias("area_m2")).withColumn("area_km2", geo.square_km("area_m2"))
