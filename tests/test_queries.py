"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import glob
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from strandline.plans import queries as shore

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(shore.ORACLE_SQL))
def test_rows_are_those_of_sql(spark, duck, name):
    want = duck.sql(shore.ORACLE_SQL[name])
    cols = sorted(want.columns)
    got = shore.QUERIES[name](spark, SF).select(*[f"`{c}`" for c in cols])
    key = lambda r: tuple(repr(v) for v in r)
    plain = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    rows = lambda it: sorted((tuple(plain(v) for v in r) for r in it), key=key)
    assert rows(map(tuple, got.collect())) == rows(want.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["transect_id", "date", "cross_distance"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(shore.QUERIES) - set(shore.ORACLE_SQL)))
def test_other_queries_have_rows(spark, name):
    assert shore.QUERIES[name](spark, SF).count() > 0


def test_reference_buffer_holds_every_vertex(spark, tmp_path):
    at = [1, 119, 120, 121, 1000, 250000]
    spark.createDataFrame([(k,) for k in at], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    got = {(r.row, r.col) for r in shore.QUERIES["reference_buffer"](spark, str(tmp_path)).collect()}
    middle = [(round((90 + 10 * (k % 3)) / 3), round(100 * k / 3)) for k in at]
    assert got == {(r + i, c + j) for r, c in middle for i in range(-4, 5) for j in range(-4, 5) if i * i + j * j <= 16}


def _fixture(spark, path, v):
    """Scenes of 64 x 64 values v (scene, row, col) as the table that the pixel views read."""
    rows = [(s * 64 + r, [float(x) for x in v[s, r]]) for s in range(len(v)) for r in range(64)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")


def _patches(true):
    """4-connected patches of true pixels, each as a list of (row, col)."""
    left, out = set(map(tuple, np.argwhere(true).tolist())), []
    while left:
        stack, own = [left.pop()], []
        while stack:
            r, c = stack.pop()
            own.append((r, c))
            for q in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if q in left:
                    left.remove(q)
                    stack.append(q)
        out.append(own)
    return out


def _without(true, least):
    out = true.copy()
    for p in _patches(true):
        if len(p) < least:
            out[tuple(zip(*p, strict=True))] = False
    return out


def test_shoreline_pipeline_by_brute_force(spark, tmp_path):
    cloud, shadow = 4018 / 4000 - 1, 3996 / 4000 - 1
    v = np.zeros((4, 64, 64))
    v[0, 10, 20], v[0, 30, 40] = cloud, shadow  # specks
    v[1, 0:8, 34:42] = cloud
    v[2, 56:64, 10:18] = shadow
    v[3, 50:, :32] = 2.0  # land, in part outside the buffer
    v[3, 5:8, 5:8] = 2.0  # a small patch of land
    _fixture(spark, tmp_path, v)
    spark.createDataFrame([(1,), (2,), (3,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    ends = np.array([(100.0 * k, 90.0 + 10 * (k % 3)) for k in (1, 2, 3)])
    row, col = np.mgrid[0:64, 0:64]
    at = np.stack([(col + 0.5) * 3, (row + 0.5) * 3], -1)
    buffer = np.zeros((64, 64), bool)
    for a, b in zip(ends, ends[1:]):
        t = np.clip(((at - a) @ (b - a)) / ((b - a) @ (b - a)), 0, 1)
        buffer |= np.hypot(*np.moveaxis(at - a - t[..., None] * (b - a), -1, 0)) <= 100
    want = set()
    for s in range(4):
        code = np.rint((v[s] + 1) * 4000).astype(int)
        bad, nodata = _without((code % 41 == 0) | (code % 37 == 0), 40), col < 2
        land, ok = _without(col + 20 * v[s] >= 32, 100), buffer & ~bad & ~nodata
        for r in range(63):
            for c in range(63):
                if ok[r : r + 2, c : c + 2].all():
                    for a, b in (((r, c), (r, c + 1)), ((r + 1, c), (r + 1, c + 1)), ((r, c), (r + 1, c)), ((r, c + 1), (r + 1, c + 1))):
                        x, y = (a[1] + b[1]) * 1.5, (a[0] + b[0]) * -1.5
                        if land[a] != land[b] and not (np.hypot(col * 3 - x, row * -3 - y)[bad | nodata] < 60).any():
                            want.add((s, x, y))
    got = {(r.scene_id, r.x, r.y) for r in shore.QUERIES["shoreline_pipeline"](spark, str(tmp_path)).collect()}
    assert got == want and {s for s, _, _ in want} == {0, 1, 2, 3}


def test_scene_cloud_cover_by_brute_force(spark, tmp_path):
    rng = np.random.default_rng(3)
    v = np.where(rng.random((3, 64, 64)) < [[[0.05]], [[0.35]], [[0.5]]], 3854, 3840) / 4000 - 1  # 14 and 0 of 256
    v[0, 20:27, 20:27] = 3854 / 4000 - 1
    _fixture(spark, tmp_path, v)
    raw = np.rint((v + 1) * 4000).astype(int) % 256 & 14 != 0
    want = {s: round(float(_without(raw[s], 40).mean()), 3) for s in range(3)}
    got = {r.scene_id: r.cloud_cover for r in shore.QUERIES["scene_cloud_cover"](spark, str(tmp_path)).collect()}
    assert got == want and want[0] > 0 and all(want[s] < raw[s].mean() - 0.02 for s in (0, 1))


def test_a_long_shore_comes_back_from_its_zones(spark, tmp_path):
    rows = [(k * 997, k, 1, 5.0) for k in range(400)]
    df = spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_linenumber int, l_quantity double")
    df.selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = shore.QUERIES["utm_roundtrip"](spark, str(tmp_path))
    assert got.count() == 400 and got.where("back").count() == 400
