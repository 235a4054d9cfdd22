"""Class scores and labels of pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIXEL = ["scene_id", "row", "col"]


def ensemble(scores: DataFrame) -> DataFrame:
    """Mean of the models' scores for each pixel and class."""
    return scores.groupBy(*PIXEL, "class_idx").agg(F.avg("score").alias("score"))


def binary_estimate(scores: DataFrame) -> DataFrame:
    """scene_id, row, col, est: (e1 + (1 - e0)) / 2 of the mean scores of classes 0 and 1."""
    e = lambda k: F.avg(F.when(F.col("class_idx") == k, F.col("score")))
    return scores.groupBy(*PIXEL).agg(((e(1) + (1 - e(0))) / 2).alias("est"))


def argmax(scores: DataFrame) -> DataFrame:
    """scene_id, row, col, label: the class of largest score, the lowest of equals; 0 all over a constant scene."""
    best = scores.groupBy(*PIXEL).agg(F.min_by("class_idx", F.struct((-F.col("score")).alias("s"), "class_idx")).alias("label"))
    flat = scores.groupBy("scene_id").agg((F.min("score") == F.max("score")).alias("_flat"))
    return best.join(flat, "scene_id").select(*PIXEL, F.when(F.col("_flat"), 0).otherwise(F.col("label")).alias("label"))


def histogram(labels: DataFrame) -> DataFrame:
    return labels.groupBy("scene_id", "label").agg(F.count(F.lit(1)).alias("n"))


def named(labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds class_name from a table of (class_idx, class_name)."""
    return labels.join(classes.select(F.col("class_idx").alias("label"), "class_name"), "label", "left")
