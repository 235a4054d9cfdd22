"""Components: chunks of one task, structs and strings as nodes, long paths, bounded memory."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.operators import graph


def plain(edges):
    above: dict = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        above[max(x, y)] = min(x, y)
    return {x: root(x) for x in above}


@pytest.mark.parametrize("chunk", [7, 64, 1 << 18])
@pytest.mark.parametrize("kind", ["long", "string", "struct<s: string, n: long>"])
def test_components_are_those_of_a_plain_union(spark, chunk, kind):
    rng = np.random.default_rng(4)
    made = {"long": lambda v: int(v), "string": lambda v: f"n{v}é", "struct<s: string, n: long>": lambda v: (f"s{v % 3}", int(v))}[kind]
    ends = [(made(a), made(b)) for a, b in rng.integers(-150, 150, (190, 2))]
    edges = [e for e in ends if e[0] != e[1]]
    rows = spark.createDataFrame([*ends, (None, ends[0][1]), (None, None)], f"a {kind}, b {kind}").repartition(3)
    plainly = lambda v: tuple(v) if isinstance(v, tuple) else v
    got = {plainly(r.node): plainly(r.component) for r in graph.connected_components(rows, chunk=chunk).collect()}
    assert got == plain(edges)


def test_a_long_path_settles(spark):
    n = 20_000
    edges = spark.range(n).select((F.col("id") * 7919 % n).alias("a")).select("a", (F.col("a") + 1).alias("b"))
    got = graph.connected_components(edges, chunk=512)
    assert got.count() == n + 1 and got.where("component <> 0").isEmpty()


def test_a_tasks_memory_is_that_of_a_chunk():
    n = 1_000_000
    at = np.random.default_rng(1).permutation(n)

    def batches():
        for i in range(0, n, 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[i : i + 10_000]), pa.array(at[i : i + 10_000] + 1)], names=["a", "b"])

    tracemalloc.start()
    out = sum(b.num_rows for b in graph._task_stars(50_000)(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < out <= n and peak < 50_000 * 250
    (whole,) = graph._task_stars(n)(batches())
    assert whole.num_rows == n and set(whole.column(1).to_pylist()) == {0}
