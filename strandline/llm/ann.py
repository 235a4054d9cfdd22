"""Nearest neighbours by a forest of random-projection trees (operator 5).

Trees split at the median of a random projection of a bounded sample; every row is in one leaf of each
tree. A query ranks the leaves of all trees in one shared priority queue, by how far (squared, over the
splits on the way) it stands outside of them, and takes the first ``pops``; what it meets there is
reranked by exact inner products. ``pops`` is calibrated on the sample for the recall asked for.

For inner products, rows get one more coordinate that gives all of them the same norm, so that the nearest
in direction is the one of largest product. Copies are one row. Leaves are searched in blocks of a bounded
number of rows and queries, so a leaf may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.staging import staged
from strandline.llm.vectors import classes, keyed, matrix, valid

BLOCK = 4096


@dataclass
class Forest:
    """directions [trees, nodes, dims], thresholds [trees, nodes]; pops: leaves that a query looks into."""

    directions: np.ndarray
    thresholds: np.ndarray
    norm: float
    pops: int

    @property
    def leaves(self) -> int:
        return self.thresholds.shape[1] + 1

    def index(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree [trees, rows]."""
        x = _lifted(x, self.norm)
        out = np.zeros((len(self.directions), len(x)), np.int64)
        for t, (r, cut) in enumerate(zip(self.directions, self.thresholds, strict=True)):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < len(cut):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", x, r[node]) > cut[node])
            out[t] = node - len(cut)
        return out

    def queue(self, q: np.ndarray) -> np.ndarray:
        """Leaves of all trees [queries, trees * leaves], in the order the shared queue gives them up."""
        q = np.pad(q, ((0, 0), (0, 1)))
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300) * self.norm
        cost = []
        for r, cut in zip(self.directions, self.thresholds, strict=True):
            side = q @ r.T - cut
            level, at = np.zeros((len(q), 1)), 0
            while at < len(cut):
                n = level.shape[1]
                s = side[:, at : at + n]
                level = np.stack([level + np.maximum(s, 0) ** 2, level + np.maximum(-s, 0) ** 2], axis=2).reshape(len(q), -1)
                at += n
            cost.append(level)
        return np.argsort(np.concatenate(cost, axis=1), axis=1, kind="stable")


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", x, x), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def grow(sample: np.ndarray, norm: float, trees: int = 4, depth: int = 6, k: int = 20, recall: float = 0.96, seed: int = 1) -> Forest:
    """Fit the trees to a sample and choose ``pops`` so that its own queries would reach ``recall`` at k."""
    rng = np.random.default_rng(seed)
    x = _lifted(sample, norm)
    nodes = (1 << depth) - 1
    directions = rng.normal(size=(trees, nodes, x.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    cuts = np.zeros((trees, nodes))
    for t in range(trees):
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            p = np.einsum("ij,ij->i", x, directions[t][at])
            for node in range((1 << level) - 1, (1 << level + 1) - 1):
                if len(own := p[at == node]):
                    cuts[t, node] = np.median(own)
            at = 2 * at + 1 + (p > cuts[t][at])
    forest = Forest(directions, cuts, norm, trees * (nodes + 1))
    asked = rng.permutation(len(sample))[:400]
    if len(sample) > 2 * k:
        near = sample[asked] @ sample.T
        near[np.arange(len(asked)), asked] = -np.inf
        best = np.argpartition(-near, k, axis=1)[:, :k]
        order = forest.queue(sample[asked])
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None], 1)
        leaf = forest.index(sample) + (np.arange(trees) * forest.leaves)[:, None]
        met = np.min([np.take_along_axis(rank, leaf[t][best], 1) for t in range(trees)], axis=0)
        forest.pops = int(np.quantile(met, recall)) + 1
    return forest


def _block_top(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k + 1 nearest rows of a block for each query of a block."""
    out: list[tuple] = []
    if len(left) and len(right):
        x, ids = np.stack(left.v.to_numpy()), left.ids.to_list()
        least = np.array([i[0] for i in ids])
        for a in range(0, len(right), 512):
            part = right.iloc[a : a + 512]
            q = np.stack(part.v.to_numpy())
            s = q @ x.T
            m = min(k + 1, len(x))
            floor = np.partition(s, len(x) - m, axis=1)[:, len(x) - m]
            slack = 1e-9 * np.linalg.norm(q, axis=1) * (np.abs(x).max() + 1)
            for i, (k1, k2) in enumerate(zip(part.k1, part.k2, strict=True)):
                near = np.flatnonzero(s[i] >= floor[i] - slack[i])
                exact = (x[near] * q[i]).sum(1)
                order = np.lexsort((least[near], -exact))
                found = sorted((-float(exact[o]), int(c)) for o in order for c in ids[near[o]])[: k + 1]
                out.append((k1, k2, [c for _, c in found], [-s_ for s_, _ in found]))
    return pd.DataFrame(out, columns=["k1", "k2", "ids", "scores"])


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, sample_rows: int = 8192, trees: int = 4, depth: int = 6, recall: float = 0.96, seed: int = 1) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found for each of ``queries``.

    Both have vec_id and embedding. Nearness is the inner product of the vectors as they are, in double
    precision; ties go to the smaller vec_id; a query is no neighbour of itself (by vec_id). Vectors that
    are null, zero, of another length than most or with a null or non-finite component take no part, as
    rows or queries. With fewer rows than k all of those found come back. A vec_id that stands in several
    rows counts once for each vector it has. Fitted on the ``sample_rows`` distinct vectors of lowest hash.
    """
    spark = rows.sparkSession
    base = staged(keyed(valid(rows)))
    own = staged(classes(base, k + 1))
    asked = keyed(valid(queries)).select("vec_id", "k1", "k2")
    stats = own.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m"), F.count(F.lit(1)).alias("n")).first()
    shape = "query_id long, rank int, vec_id long, score double"
    if not stats.n:
        return spark.createDataFrame([], shape)
    sample = np.array([r.v for r in own.orderBy("k1", "k2").limit(sample_rows).select("v").collect()])
    forest = grow(sample, float(np.sqrt(stats.m)), trees, depth, k, recall, seed)
    model = spark.sparkContext.broadcast(forest)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                f = model.value
                cell = f.index(matrix(b.column(b.schema.get_field_index("v")))) + (np.arange(len(f.directions)) * f.leaves)[:, None]
                for c in cell:
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c)], names=[*b.schema.names, "cell"])

    def pops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                order = model.value.queue(matrix(b.column(b.schema.get_field_index("v"))))[:, : model.value.pops]
                at = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1) * order.shape[1], pa.int32()), pa.array(order.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, at], names=[*b.schema.names, "cells"])

    indexed = own.mapInArrow(leaves, "k1 long, k2 long, v array<double>, ids array<long>, cell long")
    wanted = own.select("k1", "k2", "v").join(asked.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    wanted = wanted.mapInArrow(pops, "k1 long, k2 long, v array<double>, cells array<long>").select("k1", "k2", "v", F.explode("cells").alias("cell"))
    # Blocks: rows and queries of a cell are dealt by hash into as many as keep each near BLOCK; the tables of
    # counts have a row for each of trees * 2 ** depth cells.
    count = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    plan = staged(count(indexed.select("cell"), "nx").join(count(wanted.select("cell"), "nq"), "cell"))
    plan = F.broadcast(plan)
    x = indexed.join(plan, "cell").withColumn("bx", F.pmod("k1", "nx")).withColumn("bq", F.explode(F.expr("sequence(0, nq - 1)")))
    q = wanted.join(plan, "cell").withColumn("bq", F.pmod("k2", "nq")).withColumn("bx", F.explode(F.expr("sequence(0, nx - 1)")))
    block = ["cell", "bx", "bq"]
    x = x.select(*block, "k1", "k2", "v", "ids").groupBy(*[F.col(c).cast("long").alias(c) for c in block])
    q = q.select(*block, "k1", "k2", "v").groupBy(*[F.col(c).cast("long").alias(c) for c in block])
    met = x.cogroup(q).applyInPandas(lambda a, b: _block_top(a, b, k), "k1 long, k2 long, ids array<long>, scores array<double>")
    found = met.select("k1", "k2", F.explode(F.arrays_zip("ids", "scores")).alias("c")).select("k1", "k2", F.col("c.ids").alias("vec_id"), F.col("c.scores").alias("score")).distinct()
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    lists = found.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    out = asked.withColumnRenamed("vec_id", "query_id").join(lists, ["k1", "k2"])
    out = out.withColumn("near", F.slice(F.filter("near", lambda c: c.vec_id != F.col("query_id")), 1, k))
    return out.select("query_id", F.posexplode("near").alias("p", "c")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score"))
