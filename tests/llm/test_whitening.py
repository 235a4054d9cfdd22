"""Whitening against a dense eigenproblem: odd vectors, copies, few dimensions, large numbers."""

from decimal import Decimal

import numpy as np
import pytest

from strandline.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def frame(spark, vectors, extra=()):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)] + list(extra), "vec_id long, embedding array<double>")


def dense(x, k=4, scale=256):
    x = np.unique(np.floor(scale * np.asarray(x)).astype(np.int64), axis=0)
    c = x - x.sum(0) / len(x)
    e, q = np.linalg.eigh(c.T @ c / len(x))
    return x, e[::-1][:k], q[:, ::-1][:, :k], np.trace(c.T @ c / len(x))


@pytest.mark.parametrize("dims,n", [(12, 400), (70, 900)])
def test_pairs_are_those_of_the_dense_problem(spark, dims, n):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(n, dims)) * np.linspace(3, 0.5, dims)
    x[20:300] = x[19]
    odd = [(9001, None), (9002, [NAN] * dims), (9003, [1.0] * (dims - 1) + [None]), (9004, [INF] * dims), (9005, [1.0]), (9006, []), (None, [0.0] * dims), (9007, [0.0] * dims)]
    rows = frame(spark, x.tolist(), odd)
    model = whitening.fit(rows)
    whole, e, q, trace = dense(np.vstack([x, np.zeros(dims)]))
    assert model.n == len(whole) and model.sums == whole.sum(0).tolist()
    assert np.allclose(model.values, e, rtol=1e-13) and np.allclose(model.explained, e / trace, rtol=1e-12)
    assert np.abs(np.abs((model.columns * q).sum(0)) - 1).max() < 1e-12
    assert model.residuals.max() < 1e-12 * e[0] and model.identity_error < 1e-9
    got = {r.vec_id: r for r in whitening.whiten(rows, model).collect()}
    assert sorted(k for k in got if k is not None) == [*range(n), 9007] and None in got
    sign = np.sign((model.columns * q).sum(0))
    for i in (0, 19, 150, n - 1):
        xi = np.floor(256 * x[i]).astype(np.int64)
        assert got[i].deviation == Decimal(int(((model.n * xi - whole.sum(0)) ** 2).sum()))
        assert np.allclose(got[i].whitened, (xi - whole.mean(0)) @ q / np.sqrt(e) * sign, atol=1e-9)
    assert got[19].whitened == got[200].whitened


def test_few_dimensions_single_vectors_and_empty_tables(spark):
    two = frame(spark, [[1.0, 2.0], [2.0, 1.0], [4.0, 4.0]])
    model = whitening.fit(two)
    assert model.columns.shape == (2, 2) and abs(sum(model.explained) - 1) < 1e-12
    line = frame(spark, [[float(i), 2.0 * i, 0.0] for i in range(9)])
    model = whitening.fit(line)
    got = whitening.whiten(line, model).collect()
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in got) and model.identity_error < 1e-12
    one = frame(spark, [[1.5, -2.0]] * 3)
    model = whitening.fit(one)
    assert [r.deviation for r in whitening.whiten(one, model).collect()] == [0] * 3 and model.identity_error is None
    none = one.limit(0)
    assert whitening.whiten(none, whitening.fit(none)).count() == 0


def test_large_numbers_are_exact_and_other_columns_stay(spark):
    v = [[3e7 + i * 1e6, -5e7, float(i)] for i in range(50)]
    rows = spark.createDataFrame([(i, x, "a", 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, `a.b` string, deviation int")
    model = whitening.fit(rows)
    whole = np.floor(256 * np.array(v)).astype(np.int64).astype(object)
    got = whitening.whiten(rows, model)
    assert got.columns == ["vec_id", "embedding", "a.b", "deviation", "deviation_", "whitened"]
    for r in got.collect():
        assert r.deviation == 1 and r.deviation_ == Decimal(int(((50 * whole[r.vec_id] - whole.sum(0)) ** 2).sum()))


def test_query(spark):
    got = queries.op11_jacobi_davidson_whitening(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    whole, e, q, trace = dense([r.embedding for r in rows])
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {len(whole)}
    z = np.zeros((len(rows), 4))
    at = {r.vec_id: i for i, r in enumerate(rows)}
    for r in got:
        z[at[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained - e[r.component - 1] / trace) < 1e-12 and r.identity_error < 1e-9
    want = (np.floor(256 * np.array([r.embedding for r in rows])) - whole.mean(0)) @ q / np.sqrt(e)
    assert np.allclose(z * np.sign((z * want).sum(0)), want, atol=1e-9)
