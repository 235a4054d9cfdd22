"""Footprints inside a table of regions: overlaps, parts, holes, copies, crowded cells, against counting a fine grid."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import clip, overlay, scenes


def table(spark, regions):
    rows = [(r, p, [(float(x), float(y)) for x, y in ring]) for r, p, ring in regions]
    return spark.createDataFrame(rows, "region_id int, part int, ring array<struct<x: double, y: double>>")


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def footprints(spark, rings):
    return spark.createDataFrame([(i, None if r is None else [(float(x), float(y)) for x, y in r]) for i, r in enumerate(rings)], "scene_id int, ring array<struct<x: double, y: double>>")


def areas(spark, regions, rings, size):
    return {r.scene_id: r.area for r in overlay.covered_area(footprints(spark, rings), table(spark, regions), size).collect()}


@pytest.mark.parametrize("size", [10.0, 0.7])
def test_plain_cases(spark, size):
    regions = [(0, 0, box(0, 0, 1, 1)), (0, 1, box(3, 0, 4, 1)), (1, 0, box(0.5, 0.5, 2, 2)), (1, 0, box(1, 1, 1.5, 1.5)), (2, 0, box(0, 0, 1, 1)[::-1]), (2, 1, [(5, 5), (6, 6)])]
    rings = [box(-9, -9, 9, 9), box(0, 0, 1, 1), box(3.5, 0.5, 9, 9), box(7, 7, 8, 8), [(0, 0), (2, 0), (0, 2)], None, box(0, 0, 1, 1), box(1.1, 1.1, 1.4, 1.4)]
    got = areas(spark, regions, rings, size)
    want = {0: 2 + 2.25 - 0.25 - 0.25, 1: 1, 2: 0.25, 3: 0, 4: 1.25, 6: 1, 7: 0}
    assert got.pop(5) is None and set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert abs(overlay.total_area(table(spark, regions)).first().total - (1 + 1 + 2.25 - 0.25 + 1)) < 1e-12


def covered(regions, ring, lines=6000):
    """Length of the union along many upright lines: a plain sum, right to about 1e-3."""
    parts: dict = {}
    for r, p, own in regions:
        parts.setdefault((r, p), []).append(own)
    def spans(rings, x):
        ys = sorted(a[1] + (x - a[0]) * (b[1] - a[1]) / (b[0] - a[0]) for q in rings for a, b in zip(q, [*q[1:], q[0]], strict=True) if (a[0] > x) != (b[0] > x))
        return list(zip(ys[::2], ys[1::2], strict=True))
    left, right = min(p[0] for p in ring), max(p[0] for p in ring)
    total = 0.0
    for x in left + (np.arange(lines) + 0.5) * (right - left) / lines:
        inside, reached = spans([ring], x), -np.inf
        for lo, hi in sorted(s for q in parts.values() for s in spans(q, x)):
            lo = max(lo, reached)
            total += sum(max(0.0, min(hi, b) - max(lo, a)) for a, b in inside)
            reached = max(reached, hi)
    return total * (right - left) / lines


@pytest.mark.parametrize("size,full", [(8.0, 400), (1.3, 400), (8.0, 12)])
def test_random_regions(spark, monkeypatch, size, full):
    monkeypatch.setattr(overlay, "FULL", full)
    rng = np.random.default_rng(11)
    regions = []
    for k in range(14):
        middle, n = rng.uniform(-3, 3, 2), int(rng.integers(3, 9))
        turn = np.sort(rng.uniform(0, 2 * np.pi, n))
        star = middle + (rng.uniform(0.4, 1.8, n) * [np.cos(turn), np.sin(turn)]).T
        regions.append((k % 4, k, [tuple(p) for p in star]))
        if k % 3 == 0:
            regions.append((k % 4, k, [tuple(middle + 0.1 * (p - middle)) for p in star]))
    rings = [box(-2, -2, 2.5, 1), [(-4, -1), (0, -4), (4, 0.3), (0.2, 0), (1, 4)], box(-9, -9, 9, 9)]
    got = areas(spark, regions + [(9, 99, regions[0][2])], rings, size)
    for i, ring in enumerate(rings):
        want = covered(regions, ring)
        assert abs(got[i] - want) < 3e-3 * max(1, want)


def test_trapezoids_do_not_overlap_and_copies_cost_nothing(spark):
    regions = [(k, 0, box(0.1, 0.1, 2.9, 2.9)) for k in range(600)]
    t = overlay.trapezoids(table(spark, regions), 10.0)
    assert t.count() == 1 and t.first().level == 0
    none = table(spark, regions[:1]).limit(0)
    assert [r.area for r in overlay.covered_area(footprints(spark, [box(0, 0, 1, 1)]), none, 1.0).collect()] == [0.0]


def test_parts_that_lie_deep_on_each_other(spark, monkeypatch):
    monkeypatch.setattr(overlay, "FULL", 40)
    monkeypatch.setattr(overlay, "DEEPEST", 9)
    rng = np.random.default_rng(5)
    regions = [(k % 3, k, [(x - 1.5, y), (x, y - 1.2), (x + 1.5, y), (x, y + 1.2)]) for k, (x, y) in enumerate(rng.uniform(-0.4, 0.4, (150, 2)))]
    found = overlay.cells(overlay.parts_of(table(spark, regions)), 4.0)
    assert found.count() < 30_000 and found.agg(F.max("level")).first()[0] < 9
    rings = [box(-2, -2, 2.5, 1), box(-0.5, -0.5, 0.5, 0.5)]
    got = areas(spark, regions, rings, 4.0)
    assert abs(got[0] - covered(regions, rings[0], 2000)) < 1e-2 and abs(got[1] - 1) < 1e-9


def test_share_of_all_regions(spark):
    regions = table(spark, [(0, 0, box(0, 0, 1, 1)), (1, 0, box(0, 0, 1, 1)), (2, 5, box(4, 4, 5, 5))])
    items = footprints(spark, [box(0, 0, 2, 2), box(0, 0, 5, 5)])
    assert [r.scene_id for r in scenes.regions_coverage(items, regions, 0.34).collect()] == [1]
    with pytest.raises(ValueError):
        clip.clipped_area([box(0, 0, 1, 1), box(2, 0, 3, 1)])
    assert clip.plain_area([box(0, 0, 4, 4), box(0, 1, 1, 2)]) == 15
    two = footprints(spark, [box(-1, -1, 9, 9)]).select(clip.clipped_area([box(0, 0, 4, 4), box(1, 1, 2, 2)])("ring").alias("a"), F.lit(1)).first()
    assert abs(two.a - 15) < 1e-12


@pytest.mark.parametrize("deep", [overlay.HALVED, 2])
def test_a_cell_with_many_parts_deep_on_each_other(monkeypatch, deep):
    """Each pair of edges was a break of x before, and each break a round over all edges: this many did not end."""
    began, swept, plain = time.monotonic(), [], overlay._swept
    monkeypatch.setattr(overlay, "_swept", lambda *a: swept.append(len(a[0])) or plain(*a))
    rng = np.random.default_rng(8)
    n = 1500 if deep > 2 else 150
    regions = []
    for k, (x, y) in enumerate(rng.uniform(-0.2, 1.2, (n, 2))):
        if (x - 0.5) ** 2 + (y - 0.4) ** 2 < 0.2:
            continue  # leaves a hole in the middle
        a, b = rng.uniform(0.05, 0.11), rng.uniform(0.04, 0.08)
        regions.append((0, k, [(x - a, y), (x, y - b), (x + a, y), (x, y + b)]))
        if k % 4 == 0:
            regions.append((0, k, [(x - 0.01, y), (x, y - 0.01), (x + 0.01, y), (x, y + 0.01)]))
        if k % 50 == 0:
            regions.append((0, n + k, box(x, y, x + 0.05, y + 0.03)))
    ends = np.array([(*min(p, q), *max(p, q), part) for _, part, ring in regions for p, q in zip(ring, [*ring[1:], ring[0]], strict=True) if p[0] != q[0]])
    found = overlay.union_in_cell(*ends.T[:4], ends[:, 4], (0.0, 0.0, 1.0, 1.0), deep)
    area = sum((xb - xa) * (ua - la + ub - lb) / 2 for xa, xb, la, lb, ua, ub in found)
    assert abs(area - covered(regions, box(0, 0, 1, 1), 1500)) < 2e-3
    assert deep == 2 or max(swept) <= overlay.SWEPT
    assert time.monotonic() - began < 90
