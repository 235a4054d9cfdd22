"""Area of footprints inside a table of regions, whose parts may overlap, by trapezoids in grid cells.

The edges of all regions meet in the cells of a grid that is finer where edges are many. In its cell, a task cuts the
union of all parts into trapezoids that share no area, so what lies in several parts counts once. Footprints meet the
trapezoids by cell and are clipped by each of them; nothing is held whole and no polygon union is formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.functions.staging import staged, unstage
from strandline.operators.clip import inside_edges
from strandline.operators.graph import codes

#: Edges in a cell above which it is quartered, and how often at most.
FULL, DEEPEST = 400, 20

#: Edges in a box above which a task quarters it by itself, and how often at most.
SWEPT, HALVED = 24, 12

CELL = ["level", "cx", "cy"]


def parts_of(regions: DataFrame) -> DataFrame:
    """rings of each part of the regions (region_id, part, ring): equal parts once, as a union takes them."""
    return regions.groupBy("region_id", "part").agg(F.array_sort(F.collect_list("ring")).alias("rings")).dropDuplicates(["rings"])


def _edges(parts: DataFrame) -> DataFrame:
    """region_id, part, low (the part's least y), x0 < x1, y0, y1; upright edges bound no area from above."""
    low = F.array_min(F.transform(F.flatten("rings"), lambda p: p.y))
    e = parts.select("region_id", "part", low.cast("double").alias("low"), F.explode("rings").alias("ring"))
    turned = F.concat(F.slice("ring", 2, F.greatest(F.size("ring") - 1, F.lit(0))), F.slice("ring", 1, 1))

    def side(a: Column, b: Column) -> Column:
        first, last = (F.when(a.x < b.x, p).otherwise(q) for p, q in ((a, b), (b, a)))
        return F.struct(*[p[k].cast("double").alias(k + n) for p, n in ((first, "0"), (last, "1")) for k in ("x", "y")])

    return e.select("region_id", "part", "low", F.explode(F.zip_with("ring", turned, side)).alias("e")).select("region_id", "part", "low", "e.*").where("x0 < x1")


def _placed(edges: DataFrame, s: float, level: int, within: tuple[Column, Column] | None = None) -> DataFrame:
    """Each edge once in each cell of side ``s`` that it crosses or lies above, down to the bottom of its part; of the
    quarters of the cell ``within`` only, where that is given."""
    floor = lambda v: F.floor(v / s)
    at = lambda x: F.col("y0") + (x - F.col("x0")) * (F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0"))

    def some(df: DataFrame, name: str, low: Column, high: Column, parent: Column | None) -> DataFrame:
        if parent is not None:
            low, high = F.greatest(low, parent * 2), F.least(high, parent * 2 + 1)
        return df.withColumns({"_a": low, "_b": high}).where("_a <= _b").withColumn(name, F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")

    px, py = within or (None, None)
    e = some(edges, "_nx", floor(F.col("x0")), floor(F.col("x1")), px)
    a, b = F.greatest("x0", F.col("_nx") * s), F.least("x1", (F.col("_nx") + 1) * s)
    e = e.where(a < b)
    e = some(e, "_ny", floor(F.col("low")), floor(F.greatest(at(a), at(b), F.col("low"))), py)
    return e.select(F.lit(level).alias("level"), F.col("_nx").alias("cx"), F.col("_ny").alias("cy"), "region_id", "part", "low", "x0", "y0", "x1", "y1")


def cells(parts: DataFrame, size: float) -> DataFrame:
    """The edges by cell (level, cx, cy); a cell with more than ``FULL`` edges gives way to its quarters.

    All edges of a part that run over the whole of a cell tell by their number whether the part covers the cell or
    leaves it out. A cell that some part covers keeps that part alone, and any cell loses the parts that leave it out,
    so what is quartered is crossed by outlines and covered by no single part, however deep parts lie on each other.
    """
    now, done = _placed(_edges(parts), size, 0), []
    for level in range(DEEPEST + 1):
        now, s = staged(now), size / 2**level
        at = lambda x: F.col("y0") + (x - F.col("x0")) * (F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0"))
        left, right, top = F.col("cx") * s, (F.col("cx") + 1) * s, (F.col("cy") + 1) * s
        over = (F.col("x0") <= left) & (F.col("x1") >= right) & (F.least(at(left), at(right)) >= top)
        each = now.groupBy(*CELL, "region_id", "part").agg(F.bool_and(over).alias("_over"), F.count(F.lit(1)).alias("_n"))
        own = F.struct("region_id", "part")
        whole = F.min(F.when(F.col("_over") & (F.col("_n") % 2 == 1), own)).alias("_whole")
        told = each.join(each.groupBy(*CELL).agg(whole, F.sum(F.when(~F.col("_over"), F.col("_n"))).alias("_edges")), CELL)
        wanted = F.when(F.col("_whole").isNotNull(), own.eqNullSafe(F.col("_whole"))).otherwise(~F.col("_over"))
        split = F.col("_whole").isNull() & (F.col("_edges") > FULL) & F.lit(level < DEEPEST)
        told = staged(told.where(wanted).select(*CELL, "region_id", "part", split.alias("_split")))
        same = [now[c].eqNullSafe(told[c]) for c in (*CELL, "region_id", "part")]
        kept = now.join(told, same).select(*[now[c] for c in now.columns], "_split")
        done.append(kept.where("not _split").drop("_split"))
        if told.where("_split").isEmpty():
            break
        now = _placed(kept.where("_split").drop("_split"), s / 2, level + 1, (F.col("cx"), F.col("cy")))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def union_in_cell(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, part: np.ndarray, box: tuple[float, float, float, float], deep: int = HALVED) -> list[tuple[float, ...]]:
    """Trapezoids (xa, xb, la, lb, ua, ub) that make up, without overlap, what all parts cover of the box (left, bottom,
    right, top). A part covers what lies below an odd number of its edges. A box that one part covers is one trapezoid,
    parts that leave the box out go; a box that more than ``SWEPT`` edges are left in is quartered, at most ``deep``
    times, and whole quarters are joined again. So edges deep under other parts cost next to nothing."""
    left, bottom, right, top = box
    a, b = np.maximum(x0, left), np.minimum(x1, right)
    slope = (y1 - y0) / (x1 - x0)
    ya, yb = y0 + (a - x0) * slope, y0 + (b - x0) * slope
    used = np.flatnonzero((a < b) & (np.maximum(ya, yb) > bottom))  # what lies below the box is above none of it
    if not len(used):
        return []
    own = np.unique(part[used], return_inverse=True)[1]
    n = int(own.max()) + 1
    crossed = np.bincount(own, np.minimum(ya, yb)[used] < top, n) > 0
    xs = np.unique(np.r_[left, right, a[used], b[used]])
    turns = np.zeros((n, len(xs)), np.int64)
    np.add.at(turns, (own, np.searchsorted(xs, a[used])), 1)
    np.add.at(turns, (own, np.searchsorted(xs, b[used])), -1)
    odd = np.cumsum(turns, 1)[:, :-1] % 2 == 1  # of the edges above, by stretch of x
    if (~crossed & odd.all(1)).any():
        return [(left, right, bottom, bottom, top, top)]
    used = used[(crossed | odd.any(1))[own]]
    if not len(used):
        return []
    x0, y0, x1, y1, part = x0[used], y0[used], x1[used], y1[used], part[used]
    if len(used) <= SWEPT or not deep:
        return _swept(x0, y0, x1, y1, part, box)
    x, y = (left + right) / 2, (bottom + top) / 2
    boxes = [(left, bottom, x, y), (x, bottom, right, y), (left, y, x, top), (x, y, right, top)]
    found = [union_in_cell(x0, y0, x1, y1, part, quarter, deep - 1) for quarter in boxes]
    if all(f == [(q[0], q[2], q[1], q[1], q[3], q[3])] for f, q in zip(found, boxes, strict=True)):
        return [(left, right, bottom, bottom, top, top)]
    return [t for f in found for t in f]


def _swept(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, part: np.ndarray, box: tuple[float, float, float, float]) -> list[tuple[float, ...]]:
    """The same by a sweep: upright stretches between breaks of x, in which no two edges cross, are cut by the edges and
    joined where the same two edges bound them."""
    left, bottom, right, top = box
    slope = (y1 - y0) / (x1 - x0)
    breaks, near = [np.array([left, right]), x0, x1], 1e-9 * (top - bottom)
    with np.errstate(divide="ignore", invalid="ignore"):
        for level in (bottom, top):
            x = x0 + (level - y0) / slope
            breaks.append(x[(x > x0) & (x < x1)])
        for i in range(len(x0) - 1):
            d = slope[i] - slope[i + 1 :]
            x = ((y0[i + 1 :] - slope[i + 1 :] * x0[i + 1 :]) - (y0[i] - slope[i] * x0[i])) / d
            y = y0[i] + (x - x0[i]) * slope[i]
            met = (x > np.maximum(x0[i], x0[i + 1 :])) & (x < np.minimum(x1[i], x1[i + 1 :])) & (y >= bottom - near) & (y <= top + near)
            breaks.append(x[met])
    xs = np.unique(np.concatenate(breaks))
    xs = xs[np.isfinite(xs) & (xs >= left) & (xs <= right)]
    out, open_ = [], {}
    for a, b in zip(xs[:-1], xs[1:], strict=True):
        at = np.flatnonzero((x0 <= a) & (x1 >= b))
        ya, yb, middle = (y0[at] + (x - x0[at]) * slope[at] for x in (a, b, (a + b) / 2))
        # an edge is above, in or below the box in all of the stretch; rounding at its ends must not tell otherwise
        ya, yb = (np.where(middle >= top, top, np.where(middle <= bottom, bottom, np.clip(y, bottom, top))) for y in (ya, yb))
        order = np.argsort(-(ya + yb), kind="stable")
        p = part[at][order]
        by = np.argsort(p, kind="stable")
        turn = np.empty(len(p), int)
        starts = np.flatnonzero(np.r_[True, p[by][1:] != p[by][:-1]]) if len(p) else np.zeros(0, int)
        turn[by] = np.arange(len(p)) - np.repeat(starts, np.diff(np.r_[starts, len(p)]))
        deep = np.cumsum(np.where(turn % 2 == 0, 1, -1))
        before = np.r_[0, deep[:-1]] if len(deep) else deep
        tops, ends = np.flatnonzero((deep == 1) & (before == 0)), np.flatnonzero((deep == 0) & (before == 1))
        if len(deep) and deep[-1] > 0:  # the rest of the part's edges lie below the box
            ends = np.r_[ends, len(deep)]
        ya, yb, ids = np.r_[ya[order], bottom], np.r_[yb[order], bottom], np.r_[at[order], -1]
        held = {}
        for t, e in zip(tops, ends, strict=True):
            if ya[t] + yb[t] <= ya[e] + yb[e]:
                continue
            names = tuple("top" if ya[k] == yb[k] == top else "bottom" if ya[k] == yb[k] == bottom else int(ids[k]) for k in (t, e))
            if (was := open_.pop(names, None)) is not None:
                held[names] = (was[0], b, was[2], yb[e], was[4], yb[t])
            else:
                held[names] = (a, b, ya[e], yb[e], ya[t], yb[t])
        out += open_.values()
        open_ = held
    # where two edges meet, rounding must not turn the upright side over
    return [(float(xa), float(xb), float(la), float(lb), float(max(ua, la)), float(max(ub, lb))) for xa, xb, la, lb, ua, ub in (*out, *open_.values())]


def trapezoids(regions: DataFrame, size: float) -> DataFrame:
    """The union of all regions as trapezoids without overlap: level, cx, cy, xa, xb, la, lb, ua, ub (lower and upper
    ends at xa and at xb).

    regions (region_id, part, ring: array of (x, y)): a part's rings are its outline and its holes, in any order and
    direction; a region has any number of parts, and parts may overlap. ``size`` is the side of the widest cells.
    Rings of under three corners have no area; null rings are left out.
    """
    found = cells(parts_of(regions.where("ring is not null")), size)

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        level, cx, cy = (k.as_py() for k in key)
        s = size / 2**level
        value = [table.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")]
        flat = [pa.concat_arrays(table.column(c).chunks) for c in ("region_id", "part")]
        rows = union_in_cell(*value, codes(flat), (cx * s, cy * s, (cx + 1) * s, (cy + 1) * s))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        same = [pa.array([v] * len(rows), k) for v, k in ((level, pa.int32()), (cx, pa.int64()), (cy, pa.int64()))]
        return pa.table([*same, *[pa.array(c, pa.float64()) for c in columns]], names=[*CELL, "xa", "xb", "la", "lb", "ua", "ub"])

    return found.groupBy(*CELL).applyInArrow(cut, "level int, cx long, cy long, xa double, xb double, la double, lb double, ua double, ub double")


def covered_area(items: DataFrame, regions: DataFrame, size: float) -> DataFrame:
    """``items`` with ``area``, the part of each footprint (``ring``: array of (x, y), simple, of any shape) that lies in
    some region; overlapping regions count once. Equal footprints are measured once; one that meets no region has 0,
    a null one null."""
    pieces = staged(trapezoids(regions, size))
    levels = [r.level for r in pieces.select("level").distinct().collect()]
    rings = items.select("ring").where("ring is not null").distinct()
    box = geo.ring_bounds("ring")
    rings = rings.select("ring", F.transform("ring", lambda p: F.struct(p.x.cast("double").alias("x"), p.y.cast("double").alias("y"))).alias("_ring"), *[v.cast("double").alias(k) for k, v in box.items()])
    side = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(size / 2**k).alias("s")) for k in sorted(levels)])
    span = lambda a, b: F.sequence(F.floor(F.col(a) / F.col("_l.s")), F.floor(F.col(b) / F.col("_l.s")))
    if not levels:
        return items.withColumn("area", F.when(F.col("ring").isNotNull(), 0.0))
    near = rings.withColumn("_l", F.explode(side)).withColumn("cx", F.explode(span("minx", "maxx"))).withColumn("cy", F.explode(span("miny", "maxy"))).withColumn("level", F.col("_l.level"))
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    corners = [point("xa", "la"), point("xb", "lb"), point("xb", "ub"), point("xa", "ua")]
    edges = F.array(*[F.struct(p.x.alias("ax"), p.y.alias("ay"), q.x.alias("bx"), q.y.alias("by")) for p, q in zip(corners, [*corners[1:], corners[0]], strict=True)])
    meets = (F.col("minx") < F.col("xb")) & (F.col("maxx") > F.col("xa")) & (F.col("miny") < F.greatest("ua", "ub")) & (F.col("maxy") > F.least("la", "lb"))
    both = near.join(pieces, CELL).where(meets).withColumn("_part", F.aggregate(edges, F.col("_ring"), inside_edges))
    area = both.groupBy("ring").agg(F.sum(geo.ring_area("_part")).alias("area"))
    return items.join(area, "ring", "left").select(*items.columns, F.when(F.col("ring").isNotNull(), F.coalesce("area", F.lit(0.0))).alias("area"))


def total_area(regions: DataFrame) -> DataFrame:
    """One row: ``total``, the sum of the parts' areas, each less its holes, as if no two overlapped."""
    rings = regions.where("ring is not null").select("region_id", "part", geo.ring_area("ring").alias("a"))
    parts = rings.groupBy("region_id", "part").agg((2 * F.max("a") - F.sum("a")).alias("a"))
    return parts.agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("total"))
