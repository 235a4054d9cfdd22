"""Embedding whitening by Jacobi-Davidson with distributed products (operator 11).

The covariance is never formed. A product with it is one pass over the centred vectors: each task multiplies its
blocks by a few columns, sums meet in a shuffle, and the driver gets dims x columns numbers. The search space, its
Rayleigh-Ritz problem and the corrections are small and dense; corrections of all open pairs are solved side by
side by MINRES, so that one pass serves them all. Converged pairs are locked: they stay in the space and in the
projector, but get no further corrections.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType

from strandline.functions.staging import staged, unstage
from strandline.llm.textbytes import free_name

#: Bytes of vectors that a block of the fit table holds: what a task multiplies at a time.
BLOCK_BYTES = 4 << 20
EPS = float(np.finfo(np.float64).eps)


@dataclass
class Whitening:
    """n vectors with per-dimension sums; unit columns, their eigenvalues (falling) and residual norms."""

    n: int
    sums: list[int]
    columns: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float | None = None
    passes: int = 0
    scale: int = 256
    explained: list[float | None] = field(default_factory=list)


def remains(rows: DataFrame, vector: str = "embedding") -> Column:
    """Condition: the vector is there, holds finite numbers only, and has the commonest length above 0 (of
    equally common ones the shortest)."""
    v = F.col(f"`{vector}`")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    top = rows.where(good).groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n").collect()
    return F.coalesce(good & (F.size(v) == (top[0].n if top else 0)), F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """Each entry c as the long floor(scale * c)."""
    return F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * scale) + F.lit(0).cast("long"))


def fit_table(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """Each distinct whole vector once, packed in blocks (dims, data: int64 rows)."""
    x = rows.where(remains(rows, vector)).select(whole(vector, scale).alias("x")).distinct()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            m = np.concatenate(held)
            return pa.RecordBatch.from_arrays([pa.array([m.shape[1]], pa.int32()), pa.array([m.tobytes()], pa.binary())], names=["dims", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(0).flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)
            step = max(1, BLOCK_BYTES // (8 * flat.shape[1]))
            for i in range(0, len(flat), step):
                held.append(flat[i : i + step])
                size += held[-1].nbytes
                if size >= BLOCK_BYTES:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    return staged(x.mapInArrow(packed, "dims int, data binary"))


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over all blocks of ``part(x)`` [rows, width]: each task sends one row a row of the sum."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for dims, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = part(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dims).astype(np.float64))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), *[pa.array(np.ascontiguousarray(c)) for c in total.T]], names=["i", *[f"c{j}" for j in range(width)]])

    parts = blocks.mapInArrow(task, ", ".join(["i int", *[f"c{j} double" for j in range(width)]]))
    got = parts.groupBy("i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)]).collect()
    out = np.zeros((len(got), width))
    for r in got:
        out[r[0]] = r[1:]
    return out


def _sums(blocks: DataFrame) -> tuple[int, list[int], list[int]]:
    """Number of vectors, exact sums and exact sums of squares by dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, dims)
                low, high = x & 0xFFFF, x >> 16  # squares of halves fit, whatever the numbers
                square = [sum(int(v) << s for v, s in zip(p, (0, 17, 32), strict=True)) for p in zip((low * low).sum(0), (low * high).sum(0), (high * high).sum(0), strict=True)]
                number = pa.decimal128(38, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(dims), pa.int32()), pa.array(np.full(dims, len(x), np.int64)), pa.array(x.sum(0)).cast(pa.decimal128(19, 0)).cast(number), pa.array([Decimal(v) for v in square], number)],
                    names=["i", "n", "s", "q"],
                )

    got = blocks.mapInArrow(task, "i int, n long, s decimal(38,0), q decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("i").collect()
    return (got[0].n if got else 0), [int(r.s) for r in got], [int(r.q) for r in got]


def _minres(times: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, away: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Columns t with the least residual of (P (V - shift) P) t = rhs in a Krylov space of ``steps`` dimensions,
    P projecting away from the columns of ``away``; one product a step for all columns side by side."""
    off = lambda y: y - away @ (away.T @ y)
    rhs = off(rhs)
    size = np.linalg.norm(rhs, axis=0)
    basis = [rhs / np.where(size > 0, size, 1)]
    k = rhs.shape[1]
    h = np.zeros((k, steps + 1, steps))
    for j in range(steps):
        z = off(times(basis[j]) - basis[j] * shifts)
        for _ in range(2):  # the Lanczos vectors are few: orthogonal to all of them
            for i, b in enumerate(basis):
                dot = (b * z).sum(0)
                h[:, i, j] += dot
                z = z - b * dot
        z = off(z)
        norm = np.linalg.norm(z, axis=0)
        h[:, j + 1, j] = norm
        basis.append(z / np.where(norm > 0, norm, 1))
    out = np.zeros_like(rhs)
    for c in range(k):
        goal = np.zeros(steps + 1)
        goal[0] = size[c]
        y = np.linalg.lstsq(h[c], goal, rcond=1e-12)[0]
        out[:, c] = sum(y[j] * basis[j][:, c] for j in range(steps))
    return off(out)


def _orthonormal(new: np.ndarray, space: np.ndarray) -> np.ndarray:
    """``new`` as unit columns, orthogonal to ``space`` and to each other; what lies inside goes."""
    kept: list[np.ndarray] = []
    for c in new.T:
        size = np.linalg.norm(c)
        for _ in range(3):
            c = c - space @ (space.T @ c)
            for b in kept:
                c = c - b * (b @ c)
        if size > 0 and np.linalg.norm(c) > 1e-10 * size:
            kept.append(c / np.linalg.norm(c))
    return np.array(kept).T.reshape(len(space), len(kept))


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, inner: int = 4, space: int = 48, most: int = 200, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit columns, residual norms) of the ``wanted`` largest pairs of a symmetric operator.

    ``times`` multiplies a block of columns. A pair is locked once its residual is within rounding of the largest
    eigenvalue (16 eps sqrt(dims)); ends when all are, and raises after ``most`` rounds. Where rounding
    keeps residuals above that, three rounds without gain below 1e-12 count as double precision too.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dims)
    q = np.linalg.qr(rng.normal(size=(dims, min(dims, 2 * wanted))))[0]
    w = times(q)
    best, still = np.inf, 0
    for _ in range(most):
        h = q.T @ w
        theta, y = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-theta, kind="stable")
        theta, y = theta[order], y[:, order]
        u, wu = q @ y[:, :wanted], w @ y[:, :wanted]
        r = wu - u * theta[:wanted]
        size, scale = np.linalg.norm(r, axis=0), max(abs(theta[0]), 0.0)
        open_ = np.flatnonzero(size > 16 * EPS * np.sqrt(dims) * scale)
        still = still + 1 if size.max() >= 0.5 * best else 0
        best = min(best, size.max())
        if not len(open_) or q.shape[1] == dims or (still >= 3 and size.max() <= 1e-12 * scale):
            return theta[:wanted], u / np.linalg.norm(u, axis=0), size
        if q.shape[1] + len(open_) > min(space, dims) and q.shape[1] > 2 * wanted:
            keep = min(q.shape[1], 3 * wanted)
            q, w = q @ y[:, :keep], w @ y[:, :keep]
            q, back = np.linalg.qr(q)
            w = np.linalg.solve(back.T, w.T).T
        t = _minres(times, theta[open_], u, -r[:, open_], min(inner, dims))
        t = _orthonormal(t, q)
        if not t.shape[1]:
            t = _orthonormal(rng.normal(size=(dims, 1)), q)
        t = t[:, : dims - q.shape[1]]
        q, w = np.hstack([q, t]), np.hstack([w, times(t)])
    raise RuntimeError(f"residuals did not reach double precision in {most} rounds: {size / scale}")


def fit(rows: DataFrame, components: int = 4, vector: str = "embedding", scale: int = 256) -> Whitening:
    """The leading ``components`` eigenpairs of the covariance of the distinct whole vectors, and what whitening needs."""
    blocks = fit_table(rows, vector, scale)
    n, sums, squares = _sums(blocks)
    dims = len(sums)
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(0), scale=scale)
    mean = np.array([s / n for s in sums])
    passes = 0

    def times(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            x = x - mean
            return x.T @ (x @ columns)

        return _summed(blocks, part, columns.shape[1]) / n

    values, columns, residuals = leading_pairs(times, dims, components)
    trace = sum(n * q - s * s for s, q in zip(sums, squares, strict=True)) / n**2
    out = Whitening(n, sums, columns, values, trace, residuals, scale=scale)
    out.explained = [min(max(float(v), 0.0) / trace, 1.0) if trace else None for v in values]
    live = values > 64 * EPS * max(values[0], 0) * dims
    out.values = np.where(live, values, 0.0)
    if live.any():
        z = lambda x: ((x - mean) @ columns[:, live]) / np.sqrt(values[live])
        middle = _summed(blocks, lambda x: z(x).sum(0)[None], int(live.sum()))[0] / n

        def spread(x: np.ndarray) -> np.ndarray:
            c = z(x) - middle
            return c.T @ c

        out.identity_error = float(np.abs(_summed(blocks, spread, int(live.sum())) / n - np.eye(int(live.sum()))).max())
    out.passes = passes
    unstage(blocks)
    return out


def whiten(rows: DataFrame, model: Whitening, vector: str = "embedding", names: tuple[str, str] = ("deviation", "whitened")) -> DataFrame:
    """Each row whose vector remains, with ``deviation`` (decimal: sum over dimensions of (n x - sum)^2, exact) and
    ``whitened`` (array: the centred vector on each component, over the root of its eigenvalue).

    Rows go whose vector is null, empty, of another length than the commonest, or holds null or non-finite entries; zero
    vectors stay. A component without variance (a single distinct vector, fewer dimensions in use than components) has a
    null. Copies are fitted once and each gets its row; an empty table gives an empty one. Other columns stay as
    they are; the new ones give way to them by underscores.
    """
    deviation, whitened = (free_name(rows, x) for x in names)
    own = rows.schema
    kept = rows.where(remains(rows, vector)).select("*", whole(vector, model.scale)).toDF(*[f"c{i}" for i in range(len(own) + 1)])
    n, sums, mean = model.n, np.array(model.sums, object), np.array([s / model.n for s in model.sums])
    columns, root = model.columns, np.sqrt(model.values)
    bound = max((abs(s) for s in model.sums), default=0)
    schema = kept.drop(f"c{len(own)}").schema.add("deviation", DecimalType(38, 0)).add("whitened", ArrayType(DoubleType()))
    names_out = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(batch.num_columns - 1).flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)
            if len(x[0]) * (n * int(np.abs(x).max()) + bound) ** 2 < 1 << 62:
                far = pa.array(((n * x - sums.astype(np.int64)) ** 2).sum(1)).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
            else:
                exact = ((n * x.astype(object) - sums) ** 2).sum(1)
                far = pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            z = ((x - mean) @ columns) / np.where(root > 0, root, 1)
            gone = np.tile(root <= 0, len(x))
            flat = pa.array(z.ravel(), pa.float64(), mask=gone)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(root), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], far, lists], names=names_out)

    return kept.mapInArrow(task, schema).toDF(*own.names, deviation, whitened)
