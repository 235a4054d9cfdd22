"""Polygon clipping as Column expressions: the area of a footprint ring inside a region of any shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions import geometry as geo

Ring = list[tuple[float, float]]


def rings_of(region) -> list[Ring]:
    """A region as rings, the first one outer and the others holes; a plain ring is a region of its own.

    Raises where a further ring is no hole, as it leaves the first one: regions of several parts are tables, for
    overlay.covered_area().
    """
    rings = [list(region)] if isinstance(region[0][0], (int, float)) else [list(r) for r in region]
    if any(not _in_or_on(p, rings[0]) for r in rings[1:] for p in r):
        raise ValueError("a ring after the first lies outside it: several parts are a table of regions")
    return rings


def _in_or_on(p: tuple[float, float], ring: Ring) -> bool:
    inside = False
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        turn = (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)
        if turn == 0 and min(ax, bx) <= p[0] <= max(ax, bx) and min(ay, by) <= p[1] <= max(ay, by):
            return True
        if (ay > p[1]) != (by > p[1]) and (turn > 0) == (by > ay):
            inside = not inside
    return inside


def _turn(ring: Ring) -> float:
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True)) / 2


def plain_area(region) -> float:
    """Area of a region: its outer ring less its holes."""
    rings = rings_of(region)
    return abs(_turn(rings[0])) - sum(abs(_turn(r)) for r in rings[1:])


def _edges(region) -> list[tuple[float, float, float, float, float]]:
    """(x of the left end, x of the right end, y at the left end, slope, sign) of the edges that are not upright: a point
    of the region has one more edge of sign 1 than of sign -1 above it, a point outside as many."""
    out = []
    for number, ring in enumerate(rings_of(region)):
        side = (1 if _turn(ring) > 0 else -1) * (1 if number == 0 else -1)
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if ax != bx:
                x, y = (ax, ay) if ax < bx else (bx, by)
                out.append((float(x), float(max(ax, bx)), float(y), (by - ay) / (bx - ax), float(side if bx < ax else -side)))
    return out


def inside_edges(ring: Column, edge: Column) -> Column:
    """The part of a ring left of an edge (Sutherland and Hodgman 1974): 0 to 2 points for each corner."""
    side = lambda p: (edge.bx - edge.ax) * (p.y - edge.ay) - (edge.by - edge.ay) * (p.x - edge.ax)
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def corner(p, i):
        q = F.element_at(ring, F.when(i == 0, F.size(ring)).otherwise(i))
        s, t = side(p), side(q)
        u = t / F.when(t != s, t - s)
        crossing = point(q.x + u * (p.x - q.x), q.y + u * (p.y - q.y))
        here = point(p.x, p.y)
        return (
            F.when((s >= 0) & (t >= 0), F.array(here))
            .when(s >= 0, F.array(crossing, here))
            .when(t >= 0, F.array(crossing))
            .otherwise(F.slice(F.array(here), 1, 0))
        )

    return F.flatten(F.transform(ring, corner))


def clipped_area(region):
    """A function of a ring column (array of (x, y) doubles): its area inside the region; null for null.

    The region is a ring, or an outer ring and its holes, of any shape; it is a parameter of some corners, and
    each footprint costs its corners times the region's: a sum over pairs of edges, no ring is formed.
    """
    # the products of signs take away what lies below both rings, so a pair counts for how far one edge is under the other
    edges, zero = _edges(region), F.lit(0.0)

    def below(e: Column, f: tuple[float, float, float, float, float]) -> Column:
        left, right = F.greatest(e.l, F.lit(f[0])), F.least(e.r, F.lit(f[1]))
        gap = lambda x: e.y + (x - e.l) * e.m - (f[2] + (x - f[0]) * f[3])
        low, high = F.least(gap(left), zero), F.least(gap(right), zero)
        part = F.when(gap(left) * gap(right) >= 0, (low + high) / 2).otherwise(-(low + high) * (low + high) / (2 * F.abs(gap(right) - gap(left))))
        return F.when(left < right, e.s * f[4] * part * (right - left)).otherwise(zero)

    def side(p: Column, q: Column) -> Column:
        ax, ay, bx, by = (v.cast("double") for v in (p.x, p.y, q.x, q.y))
        names = {"l": F.least(ax, bx), "r": F.greatest(ax, bx), "y": F.when(ax < bx, ay).otherwise(by), "m": (by - ay) / F.when(bx != ax, bx - ax), "s": F.signum(ax - bx)}
        return F.struct(*[v.alias(k) for k, v in names.items()])

    def area(ring: Column | str) -> Column:
        ring = geo.c(ring)
        turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        sides = F.zip_with(ring, turned, side)
        return F.abs(F.aggregate(sides, zero, lambda t, e: sum((below(e, f) for f in edges), t)))

    return area
