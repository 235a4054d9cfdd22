"""Segments in order: random grids against a plain walk, strands of every size, rings over many tiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import chains, contours
from tests.test_rasters import pixels


def walked(segs):
    """{least vertex: vertices in order} by following one segment after the other."""
    nxt, out = {(a, b): (c, d) for a, b, c, d in segs}, {}
    starts = sorted(set(nxt) - set(nxt.values()))
    for s in [*starts, *sorted(nxt)]:
        line = [s]
        while line[-1] in nxt:
            line.append(nxt.pop(line[-1]))
        if len(line) > 1:
            out[min(line)] = line
    return out


@pytest.mark.parametrize("tile,chunk", [(256, 1 << 18), (3, 5), (8, 1)])
def test_lines_are_those_of_a_walk(spark, tile, chunk):
    rng = np.random.default_rng(8)
    grid = (rng.random((26, 31)) < 0.45).astype(float)
    grid[rng.random(grid.shape) < 0.02] = np.nan
    grid[2:20, 3] = grid[2:20, 12] = grid[2, 3:13] = grid[19, 3:13] = 1
    segs = contours.segments(pixels(spark, grid).unionByName(pixels(spark, 1 - grid, scene=7)))
    segs = segs.checkpoint()
    got: dict = {}
    for r in contours.chained(segs, tile, chunk).collect():
        got.setdefault((r.scene_id, r.contour_id), []).append((r.seq, int(2 * r.row), int(2 * r.col), r.part))
    for scene in (0, 7):
        want = walked([tuple(r)[1:] for r in segs.where(F.col("scene_id") == scene).collect()])
        mine = {(k >> 32, k & 0xFFFFFFFF): sorted(v) for (s, k), v in got.items() if s == scene}
        assert set(mine) == set(want) and len(want) > 20
        for low, line in want.items():
            assert [v[0] for v in mine[low]] == list(range(len(line))) and {v[3] for v in mine[low]} == {0}
            assert [(r, c) for _, r, c, _ in mine[low]] == line
        assert any(v[0] == v[-1] for v in want.values()) and any(v[0] != v[-1] for v in want.values())


def test_no_segments(spark):
    none = spark.createDataFrame([], "scene_id int, r0 long, c0 long, r1 long, c1 long")
    assert contours.chained(none).count() == 0


def test_a_ring_of_a_million_segments(spark):
    side = 250_000
    i = F.col("id")
    k, at = F.floor(i / side), i % side

    def corner(k, at):
        return F.when(k == 0, at).when(k == 1, side).when(k == 2, side - at).otherwise(0), F.when(k == 0, 0).when(k == 1, at).when(k == 2, side).otherwise(side - at)

    n = (i + 1) % (4 * side)
    r0, c0 = corner(k, at)
    r1, c1 = corner(F.floor(n / side), n % side)
    segs = spark.range(4 * side).select(F.lit(0).alias("scene_id"), r0.alias("r0"), c0.alias("c0"), r1.alias("r1"), c1.alias("c1"), i.alias("want"))
    out = chains.ordered(segs, tile=1024, chunk=100_000).join(segs.select("r0", "c0", "want"), ["r0", "c0"])
    row = out.agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(F.col("seq") - F.col("want"))).alias("off"), F.min("length").alias("length"), F.bool_and("ring").alias("ring"), F.max("low").alias("low")).first()
    assert (row.n, row.off, row.length, row.ring) == (4 * side, 0, 4 * side, True) and (row.low.r, row.low.c) == (0, 0)


def test_local_strands():
    start, end = np.array([3, 1, 9, 5, 7]), np.array([4, 3, 5, 9, 8])
    head, place, ring = chains.local_strands(start, end)
    assert head.tolist() == [1, 1, 3, 3, 4] and place.tolist() == [1, 0, 1, 0, 0] and ring.tolist() == [False, False, True, True, False]
