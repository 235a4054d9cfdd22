"""Image quality verdicts: score, resume and merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def verdicts(images: DataFrame, logit: str = "logit") -> DataFrame:
    """Adds im_classes (good if the sigmoid is above its complement, so a tie is bad) and im_scores."""
    s = 1 / (1 + F.exp(-F.col(logit)))
    return images.withColumn("im_classes", F.when(s > 1 - s, "good").otherwise("bad")).withColumn("im_scores", F.greatest(s, 1 - s))


def not_yet_scored(images: DataFrame, done: DataFrame, key: str = "im_paths") -> DataFrame:
    return images.join(done.select(key).distinct(), key, "left_anti")


def merged(old: DataFrame, new: DataFrame, key: str = "im_paths") -> DataFrame:
    """Both tables' verdicts, the old one where both have the key."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    own = Window.partitionBy(key).orderBy("_new", *[c for c in both.columns if c not in ("_new", key)])
    return both.withColumn("_r", F.row_number().over(own)).where("_r = 1").drop("_r", "_new")


def good(images: DataFrame) -> DataFrame:
    return images.where(F.col("im_classes") == "good")


def folder() -> Column:
    """``good``, or ``bad`` for anything else, null too."""
    return F.when(F.col("im_classes") == "good", "good").otherwise("bad")
