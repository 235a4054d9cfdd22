"""Connected patches of pixels: tile by tile in numpy, joined across tile borders by the graph operator."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.staging import dealt, staged, tasks_for
from strandline.operators.graph import connected_components

#: A pixel's number inside its scene: row * ROW + col.
ROW = 1 << 32


def tile_labels(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """The least pixel number of each pixel's 4-connected patch among the given pixels."""
    code = row.astype(np.int64) * ROW + col.astype(np.int64)
    order = np.argsort(code)
    s = code[order]
    n = len(s)
    label = np.arange(n)
    links = []
    for step in (1, ROW):
        at = np.searchsorted(s, s + step)
        ok = at < n
        ok[ok] &= s[at[ok]] == s[ok] + step
        links.append((np.flatnonzero(ok), at[ok]))
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    while (label[label] != label).any():
        label = label[label]
    out = np.empty(n, np.int64)
    out[order] = s[label]
    return out


def patches(pixels: DataFrame, least: int = 1, tile: int = 256, tasks: int | None = None) -> DataFrame:
    """scene_id, row, col, component, size of the given (true) pixels, in patches of at least ``least`` pixels.

    4-connectivity; component is the least pixel number in the patch. A task sees one tile's pixels; patches
    that touch a tile border are joined as a graph with a node a tile's patch, so a patch may span a scene. Pixels are
    dealt to ``tasks`` tasks, by default so many that each holds some 250,000 rows.
    """
    kind = pixels.schema["scene_id"].dataType.simpleString()
    tiled = pixels.select("scene_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))
    tasks = tasks or tasks_for(tiled)
    tiled = tiled.withColumn("_tr", F.floor(F.col("row") / tile)).withColumn("_tc", F.floor(F.col("col") / tile))

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        row, col = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        once = np.unique(row * ROW + col, return_index=True)[1]
        row, col = row[once], col[once]
        return pd.DataFrame({"scene_id": pdf["scene_id"].iloc[0], "row": row, "col": col, "local": tile_labels(row, col)})

    own = staged(tiled.repartition(tasks, "scene_id", "_tr", "_tc").groupBy("scene_id", "_tr", "_tc").applyInPandas(label, f"scene_id {kind}, row long, col long, local long"))
    node = F.struct("scene_id", "local")
    edges = None
    for axis, dr, dc in (("row", 1, 0), ("col", 0, 1)):
        low = own.where(F.col(axis) % tile == tile - 1).select("scene_id", (F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col"), node.alias("a"))
        high = own.where(F.col(axis) % tile == 0).select("scene_id", "row", "col", node.alias("b"))
        found = low.join(high.hint("merge"), ["scene_id", "row", "col"]).select("a", "b")
        edges = found if edges is None else edges.union(found)
    joined = connected_components(edges).select(F.col("node.scene_id").alias("scene_id"), F.col("node.local").alias("local"), F.col("component.local").alias("c"))
    out = dealt(own, tasks, "scene_id", "local").join(dealt(joined, tasks, "scene_id", "local"), ["scene_id", "local"], "left").select("scene_id", "row", "col", F.coalesce("c", "local").alias("component"))
    sizes = out.groupBy("scene_id", "component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least)
    return dealt(out, tasks, "scene_id", "component").join(dealt(sizes, tasks, "scene_id", "component"), ["scene_id", "component"]).select("scene_id", "row", "col", "component", "size")
