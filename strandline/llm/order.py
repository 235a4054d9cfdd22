"""Ranks and prefix sums in hash-random order, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a range of keys holds on average; ranges are the unit of sorting.
RANGE_ROWS = 20_000


def random_key(seed: int, *cols: str | Column) -> Column:
    """A uniform key in [0, 2**63) that depends on the row's columns alone, so reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 1)


def prefix(rows: DataFrame, n_rows: int, group: list[str], at: Column, order: list[str], **measures: str) -> DataFrame:
    """Adds for each ``name=column`` the sum of that column over the rows of the group that come earlier, as
    ``name``, and over the whole group, as ``name_all``. Column "1" counts rows.

    ``at`` is the row's place in [0, 1), which ``order`` must refine. Places are cut into equal ranges, about
    ``n_rows / RANGE_ROWS`` of them; each (group, range) is sorted by itself, and only the sums of ranges
    are accumulated across a group. Places must be spread evenly; a group may hold any share of the rows.
    """
    ranges = max(1, n_rows // RANGE_ROWS)
    rows = rows.withColumn("_range", F.least(F.floor(at * ranges), F.lit(ranges - 1)).cast("int"))
    one = lambda c: F.lit(1) if c == "1" else F.col(c)
    sums = rows.groupBy(*group, "_range").agg(*[F.sum(one(c)).alias(f"_{m}") for m, c in measures.items()])
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *group, "_range", *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_{m}") for m in measures], *[F.sum(f"_{m}").over(whole).alias(f"{m}_all") for m in measures]
    )
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", *[F.coalesce(F.sum(one(c)).over(inside), F.lit(0)).alias(m) for m, c in measures.items()])
    out = rows.join(sums, [*group, "_range"])
    return out.select(*[c for c in rows.columns if c not in measures and c != "_range"], *[(F.col(m) + F.col(f"_{m}")).alias(m) for m in measures], *[f"{m}_all" for m in measures])
