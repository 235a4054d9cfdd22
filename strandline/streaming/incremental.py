"""Incremental runs: partial shoreline results, resumed verdicts, order states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.operators.quality import verdicts
from strandline.operators.transects import cross_distance

TERMINAL = ("success", "failed", "cancelled")


def series_as_scenes_arrive(spark: SparkSession, source: str, schema: str, transects: DataFrame, out: str, checkpoint: str, files: int = 3, **settings) -> StreamingQuery:
    """Shoreline points that arrive as Parquet files (``files`` a batch) -> series under ``out`` by date.

    A batch rewrites the dates that it has points of, from all of their points so far; other dates stay.
    Statistics are by (transect, date), so with mode ``nan`` or ``max`` the result is that of one batch run;
    ``auto`` looks at all dates and is for a run over the whole.
    """
    points = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)

    def merge(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        dates = batch.select("date").distinct()
        known = s.read.schema(schema).parquet(source).join(dates, "date", "left_semi")
        series = cross_distance(known, transects, **settings)
        series.withColumn("day", F.date_format("date", "yyyy-MM-dd")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(out)

    return points.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def resumed_verdicts(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, files: int = 10) -> StreamingQuery:
    """Image scores (im_paths, logit) that arrive as files -> verdicts, each path once, over any number of restarts."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    once = verdicts(rows.dropDuplicates(["im_paths"])).select("im_paths", "im_classes", "im_scores")
    return once.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def order_states(events: DataFrame) -> DataFrame:
    """order_id, state, changed, done: the latest state of each order; batch or stream (update mode)."""
    last = events.groupBy("order_id").agg(F.max(F.struct("changed", "state")).alias("s"))
    return last.select("order_id", F.col("s.state").alias("state"), F.col("s.changed").alias("changed"), F.col("s.state").isin(*TERMINAL).alias("done"))
