import numpy as np
import pytest

from strandline.llm import ann, neardup, vectors


def table(spark, x, extra=()):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


ODD = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [1.0] * 15 + [None]), (9005, [float("inf")] * 16), (9006, [1.0]), (None, [1.0] * 16)]


def clustered(n=1500, dims=16, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[100:160] = x[99] + 0.05 * rng.normal(size=(60, dims)).astype(np.float32)
    x[200:230] = x[199]
    for k in range(300, 340):  # pairs round the threshold
        u = x[k] / np.linalg.norm(x[k])
        z = rng.normal(size=dims)
        z -= (z @ u) * u
        z /= np.linalg.norm(z)
        cos = 0.9 + (k - 320) * 2e-3
        x[k + 40] = cos * u + np.sqrt(1 - cos * cos) * z
    return x


def test_links_are_those_of_all_pairs(spark):
    x = clustered()
    got = {r.vec_id: r for r in neardup.near_duplicates(table(spark, x, ODD)).collect()}
    u = neardup.units(x.astype(np.float64))
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    assert len(got) == len(x) + len(ODD)
    assert [got[i].n_links for i in range(len(x))] == near.sum(1).tolist()
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(near, label[None], len(x)).min(1))
        if (new == label).all():
            break
        label = new
    assert [got[i].component_id for i in range(len(x))] == label.tolist()
    assert all(got[i].kept == (label[i] == i) for i in range(len(x)))
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k, _ in ODD if k)
    assert got[None].n_links == 0 and got[None].kept


def test_near_duplicates_without_rows(spark):
    assert neardup.near_duplicates(table(spark, [])).count() == 0
    assert neardup.near_duplicates(table(spark, [], ODD[:3])).count() == 3


def test_calibration_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(5)
    fitted = neardup.calibrate(rng.normal(size=(500, 64)), 8192, 20, 0.9, 0.999)
    assert fitted.need >= 2 and np.isfinite(fitted.window)


@pytest.mark.parametrize("block", [64, 4096])
def test_neighbours_reach_the_recall(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    x = clustered()
    rows = table(spark, x, ODD)
    got: dict = {}
    for r in ann.nearest(rows, rows.where("vec_id % 20 = 0"), depth=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, len(x), 20))
    d, hit = x.astype(np.float64), 0
    for q, near in got.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, 21)) and q not in [v for _, v, _ in near]
        s = d @ d[q]
        assert all(abs(s[v] - score) < 1e-9 for _, v, score in near)
        assert [(v) for _, v, _ in near] == [v for v, _ in sorted(((v, sc) for _, v, sc in near), key=lambda p: (-p[1], p[0]))]
        s[q] = -np.inf
        hit += len({v for _, v, _ in near} & set(np.lexsort((np.arange(len(s)), -s))[:20].tolist()))
    assert hit / (20 * len(got)) >= 0.9


def test_copies_and_small_tables(spark):
    rows = table(spark, [[1.0, 0.0]] * 40 + [[0.0, 1.0]])
    got = sorted((r.rank, r.vec_id, r.score) for r in ann.nearest(rows, rows.where("vec_id = 3")).collect())
    assert got == [(i + 1, v, 1.0) for i, v in enumerate([v for v in range(21) if v != 3])]
    few = table(spark, [[1.0, 0.0], [2.0, 0.0], [-1.0, 5.0]])
    assert sorted((r.rank, r.vec_id) for r in ann.nearest(few, few.where("vec_id = 0")).collect()) == [(1, 1), (2, 2)]
    assert ann.nearest(few.limit(0), few).count() == 0


def test_which_vectors_count(spark):
    rows = table(spark, [[1.0] * 16] * 2, ODD)
    assert sorted(r.vec_id for r in vectors.valid(rows).collect()) == [0, 1]
