"""Plane geometry and map projection as Column expressions: no geometry type, no UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def c(x: Column | str | float) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(float(x))


# --- points, segments, rings ---------------------------------------------------------------------------


def distance(x0, y0, x1, y1) -> Column:
    return F.sqrt(F.pow(c(x1) - c(x0), 2) + F.pow(c(y1) - c(y0), 2))


def along_across(x, y, x0, y0, x1, y1) -> tuple[Column, Column]:
    """Chainage and offset of a point in the frame of the line (x0, y0) -> (x1, y1)."""
    dx, dy = c(x1) - c(x0), c(y1) - c(y0)
    length = F.sqrt(dx * dx + dy * dy)
    px, py = c(x) - c(x0), c(y) - c(y0)
    return (px * dx + py * dy) / length, (py * dx - px * dy) / length


def at_chainage(d, x0, y0, x1, y1) -> tuple[Column, Column]:
    """The point at a chainage of the line, by its bearing."""
    theta = F.atan2(c(y1) - c(y0), c(x1) - c(x0))
    return c(x0) + c(d) * F.cos(theta), c(y0) + c(d) * F.sin(theta)


def segment_distance(x, y, x0, y0, x1, y1) -> Column:
    """Distance of a point from a segment; a segment without length is a point."""
    dx, dy = c(x1) - c(x0), c(y1) - c(y0)
    square = dx * dx + dy * dy
    along = (c(x) - c(x0)) * dx + (c(y) - c(y0)) * dy
    u = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), along / square))).otherwise(F.lit(0.0))
    return distance(x, y, c(x0) + u * dx, c(y0) + u * dy)


def ring_area(ring: Column | str) -> Column:
    """Area of a polygon ring, an array of (x, y), closed or open, by the shoelace sum."""
    ring = c(ring)
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, turned, lambda a, b: a.x * b.y - b.x * a.y)
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)) / 2


def in_ring(x, y, ring: Column | str) -> Column:
    """Whether a point lies in a polygon ring: the ray to the right crosses it an odd number of times."""
    ring, x, y = c(ring), c(x), c(y)
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))

    def crosses(a, b):
        spans = (a.y > y) != (b.y > y)
        return F.when(spans & (x < (b.x - a.x) * (y - a.y) / (b.y - a.y) + a.x), 1).otherwise(0)

    return F.aggregate(F.zip_with(ring, turned, crosses), F.lit(0), lambda s, t: s + t) % 2 == 1


def ring_bounds(ring: Column | str) -> dict[str, Column]:
    ring = c(ring)
    xs, ys = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    return {"minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys)}


def box_overlap(a: tuple, b: tuple) -> Column:
    """Area that two boxes (minx, miny, maxx, maxy) share; 0 if none."""
    w = F.least(c(a[2]), c(b[2])) - F.greatest(c(a[0]), c(b[0]))
    h = F.least(c(a[3]), c(b[3])) - F.greatest(c(a[1]), c(b[1]))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def boxes_meet(a: tuple, b: tuple) -> Column:
    """Whether two boxes share a point, borders included; plain comparisons, so a scan can prune by them."""
    return (c(a[0]) <= c(b[2])) & (c(b[0]) <= c(a[2])) & (c(a[1]) <= c(b[3])) & (c(b[1]) <= c(a[3]))


def square_km(m2) -> Column:
    return c(m2) / 1e6


def square_m(km2) -> Column:
    return c(km2) * 1e6


# --- pixel grids ---------------------------------------------------------------------------------------


def pixel_to_world(row, col, g: list) -> tuple[Column, Column]:
    """World coordinates by the georeference g = [x0, dx/dcol, dx/drow, y0, dy/dcol, dy/drow]."""
    g = [c(v) for v in g]
    return g[0] + c(col) * g[1] + c(row) * g[2], g[3] + c(col) * g[4] + c(row) * g[5]


def world_to_pixel(x, y, g: list) -> tuple[Column, Column]:
    """(row, col), not rounded: the inverse of pixel_to_world in closed form."""
    g = [c(v) for v in g]
    det = g[1] * g[5] - g[2] * g[4]
    u, v = c(x) - g[0], c(y) - g[3]
    return (g[1] * v - g[4] * u) / det, (g[5] * u - g[2] * v) / det


# --- WGS84 <-> UTM, Krueger's series -------------------------------------------------------------------

_A, _FL, _K0, _E0 = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
_N = _FL / (2 - _FL)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def utm_epsg(lon, lat, wrap: bool = False) -> Column:
    """EPSG code of the UTM zone of a point; ``wrap`` puts longitude 180 in zone 1 instead of 61."""
    zone = F.floor((c(lon) + 180) / 6)
    zone = (zone % 60 if wrap else zone) + 1
    return (F.when(c(lat) >= 0, 32600).otherwise(32700) + zone).cast("int")


def _central(epsg: Column) -> Column:
    return F.radians((epsg % 100) * 6 - 183.0)


def _sphere(lon, lat, epsg: Column) -> tuple[Column, Column]:
    """The point on the sphere of the same area, as its northing and easting in radians."""
    phi, lam = F.radians(c(lat)), F.radians(c(lon)) - _central(epsg)
    e = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    return F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))


def _plane(xi: Column, eta: Column, epsg: Column) -> tuple[Column, Column]:
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    n0 = F.when(epsg >= 32700, 1e7).otherwise(0.0)
    return _E0 + _K0 * _R * east, n0 + _K0 * _R * north


def to_utm(lon, lat, epsg) -> tuple[Column, Column]:
    """Easting and northing in the UTM zone ``epsg`` (326zz or 327zz)."""
    epsg = c(epsg) if not isinstance(epsg, int) else F.lit(epsg)
    return _plane(*_sphere(lon, lat, epsg), epsg)


def with_utm(df: DataFrame, lon: str, lat: str, epsg: str, x: str = "x", y: str = "y") -> DataFrame:
    """``df`` with to_utm() of its columns, step by step: each step is computed once, in small generated code."""
    xi, eta = _sphere(F.col(lon), F.col(lat), F.col(epsg))
    east, north = _plane(F.col("_xi"), F.col("_eta"), F.col(epsg))
    return df.withColumns({"_xi": xi, "_eta": eta}).withColumns({x: east, y: north}).drop("_xi", "_eta")


def with_lonlat(df: DataFrame, x: str, y: str, epsg: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``df`` with from_utm() of its columns, step by step in the same way."""
    xi0, eta0 = _unrolled(F.col(x), F.col(y), F.col(epsg))
    found = _ellipsoid(F.col("_xi"), F.col("_eta"), F.col(epsg))
    return df.withColumns({"_xi": xi0, "_eta": eta0}).withColumns({lon: found[0], lat: found[1]}).drop("_xi", "_eta")


def _unrolled(x, y, epsg: Column) -> tuple[Column, Column]:
    n0 = F.when(epsg >= 32700, 1e7).otherwise(0.0)
    xi, eta = (c(y) - n0) / (_K0 * _R), (c(x) - _E0) / (_K0 * _R)
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return xi0, eta0


def _ellipsoid(xi0: Column, eta0: Column, epsg: Column) -> tuple[Column, Column]:
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(_central(epsg) + F.atan2(F.sinh(eta0), F.cos(xi0))), F.degrees(phi)


def from_utm(x, y, epsg) -> tuple[Column, Column]:
    """Longitude and latitude of a point of the UTM zone ``epsg``."""
    epsg = c(epsg) if not isinstance(epsg, int) else F.lit(epsg)
    return _ellipsoid(*_unrolled(x, y, epsg), epsg)
