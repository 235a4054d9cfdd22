"""Pixel values: reflectance, stretches, band order and statistics. Pixels are rows (scene_id, row, col, band, dn)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_uint16(v: Column, overflow: str = "null") -> Column:
    """Truncated to an integer; outside 0..65535 null, or wrapped round with ``overflow="wrap"``."""
    n = v.cast("long")
    return (F.pmod(n, F.lit(65536)) if overflow == "wrap" else F.when(n.between(0, 65535), n)).cast("int")


def reflectance(pixels: DataFrame, coefficients: DataFrame, missing: float | None = None, overflow: str = "null") -> DataFrame:
    """Adds toa: dn * coefficient * 10000 as uint16, by (scene_id, band) or by band alone.

    A band without a coefficient drops out, or has ``missing`` as its coefficient.
    """
    on = [c for c in ("scene_id", "band") if c in coefficients.columns]
    both = pixels.join(coefficients.select(*on, "coeff"), on, "inner" if missing is None else "left")
    k = F.col("coeff") if missing is None else F.coalesce("coeff", F.lit(missing))
    return both.withColumn("toa", to_uint16(F.col("dn") * k * 10000, overflow)).drop("coeff")


def scaled_float(v: Column, overflow: str = "null") -> Column:
    """A reflectance in 0..1 as uint16: infinite values give 0, the others ten thousand times themselves."""
    return to_uint16(F.when(F.abs(v) == float("inf"), 0.0).otherwise(v) * 10000, overflow)


def stretched(pixels: DataFrame, value: str = "dn") -> DataFrame:
    """Adds stretched: min-max over the scene's band to 0..255, truncated; a constant band gives 0.

    Minimum and maximum are a small table (two numbers a scene and band), joined back by hash.
    """
    ends = pixels.groupBy("scene_id", "band").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    v = (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 255
    return pixels.join(ends, ["scene_id", "band"]).withColumn("stretched", F.when(F.col("_hi") > F.col("_lo"), F.floor(v)).otherwise(0).cast("int")).drop("_lo", "_hi")


def to_rgb(pixels: DataFrame, n: int = 3) -> DataFrame:
    """Blue, green, red, ... to red, green, blue, ...: bands renumbered, the first n kept."""
    band = F.when(F.col("band") <= 3, 4 - F.col("band")).otherwise(F.col("band"))
    return pixels.withColumn("band", band).where(F.col("band") <= n)


def bands(pixels: DataFrame, wanted: list[int]) -> DataFrame:
    return pixels.where(F.col("band").isin(list(wanted)))


def band_stats(pixels: DataFrame, value: str = "dn") -> DataFrame:
    """scene_id, band, lo, hi, mean, sd (population), n."""
    v = F.col(value)
    return pixels.groupBy("scene_id", "band").agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"), F.count(v).alias("n"))


def band_histogram(pixels: DataFrame, buckets: int = 256, value: str = "dn") -> DataFrame:
    """scene_id, band, bucket, n over equal widths between a band's minimum and maximum (the last bucket closed)."""
    ends = pixels.groupBy("scene_id", "band").agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    b = F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets)
    b = F.when(F.col("hi") > F.col("lo"), F.least(b, F.lit(buckets - 1))).otherwise(0).cast("int")
    return pixels.join(ends, ["scene_id", "band"]).groupBy("scene_id", "band", b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def otsu(values: DataFrame, by: list[str], value: str, buckets: int = 256) -> DataFrame:
    """by, threshold: the bucket centre that parts the values best (Otsu 1979), the first of equals.

    Cumulative sums run over the at most ``buckets`` rows of a group's histogram. A constant group has its
    value as threshold.
    """
    ends = values.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    b = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets), F.lit(buckets - 1))
    hist = values.join(ends, by).groupBy(*by, "lo", "hi", F.when(F.col("hi") > F.col("lo"), b).otherwise(0).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    centre = F.col("lo") + (F.col("bucket") + 0.5) * (F.col("hi") - F.col("lo")) / buckets
    hist = hist.withColumn("centre", centre)
    up = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy(*by)
    total, s = F.sum("n").over(all_), F.sum(F.col("n") * F.col("centre")).over(all_)
    w0, s0 = F.sum("n").over(up), F.sum(F.col("n") * F.col("centre")).over(up)
    between = F.when(total > w0, w0 * (total - w0) * F.pow(s0 / w0 - (s - s0) / (total - w0), 2)).otherwise(0.0)
    hist = hist.withColumn("v", between)
    return hist.groupBy(*by).agg(F.max_by("centre", F.struct("v", (-F.col("bucket")).alias("b"))).alias("threshold"))


def thresholded(values: DataFrame, by: list[str], value: str, use_otsu: bool = True, fixed: float = 0.5) -> DataFrame:
    """Adds label: 1 where the value is above its group's threshold, or above ``fixed``."""
    if not use_otsu:
        return values.withColumn("label", (F.col(value) > fixed).cast("int"))
    return values.join(otsu(values, by, value), by).withColumn("label", (F.col(value) > F.col("threshold")).cast("int")).drop("threshold")
