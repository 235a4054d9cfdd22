"""Vector tables: which rows count, and copies as one class."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """Condition: vec_id and vector are not null, the vector is not zero and holds finite numbers only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.col(vector)
    good = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    return F.coalesce(good, F.lit(False))


def takes_part(rows: DataFrame, vector: str = "embedding") -> Column:
    """Condition: the vector is usable and has the commonest length (of equally common ones the shortest)."""
    v, good = F.col(vector), usable(vector)
    top = rows.where(good).groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n").collect()
    return F.coalesce(good & (F.size(v) == (top[0].n if top else 0)), F.lit(False))


def valid(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    return rows.where(takes_part(rows, vector))


def keyed(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, v (array of doubles) and a 128-bit key (k1, k2) that copies share."""
    v = F.col(vector).cast("array<double>")
    return rows.select("vec_id", v.alias("v"), F.xxhash64(v).alias("k1"), F.xxhash64(F.lit(1), v).alias("k2"))


def classes(rows: DataFrame, ids: int) -> DataFrame:
    """One row per distinct vector: k1, k2, v and its ``ids`` smallest vec_id, in order. ``rows`` as from keyed()."""
    own = Window.partitionBy("k1", "k2").orderBy("vec_id")
    few = rows.withColumn("_r", F.row_number().over(own)).where(F.col("_r") <= ids)
    return few.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a 2-D array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
