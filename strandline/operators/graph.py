"""Connected components over an edge table, by stars, with a task's own edges joined up in chunks first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.staging import staged, unstage

#: Edges that a task joins up at a time: some 200 bytes of memory each, whatever the task reads.
CHUNK = 1 << 18


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60, chunk: int = CHUNK) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node reachable.

    In each round every task replaces the edges that it reads, ``chunk`` at a time, by stars round the least node,
    and then a large-star and a small-star step (Kiveris et al., "Connected Components in MapReduce and Beyond",
    2014) joins up the chunks': the edge set shrinks to one star per component in O(log^2 n) rounds, whatever the
    diameter, and no step gathers a component in one place. A task's memory is that of one chunk. Null ends and
    self loops are ignored. Raises if ``max_rounds`` do not suffice. Ends may be structs.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")
    e = staged(e.mapInArrow(_task_stars(chunk), e.schema))
    for _ in range(max_rounds):
        after = staged(_star(_star(e.mapInArrow(_task_stars(chunk), e.schema), large=True), large=False))
        unstage(e)
        e = after
        if _settled(e):
            roots = e.select(F.col("b").alias("node"), F.col("b").alias("component"))
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _task_stars(chunk: int):
    """Map over edges: those of each ``chunk`` edges as stars (node, least node) of the components that they make."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, chunk - n))
                at += held[-1].num_rows
                n += held[-1].num_rows
                if n == chunk:
                    yield stars(pa.Table.from_batches(held))
                    held, n = [], 0
        if held:
            yield stars(pa.Table.from_batches(held))

    return task


def codes(columns: list[pa.Array]) -> np.ndarray:
    """A whole number for each row of the columns: equal for equal rows, and in their order; structs go by field."""
    out = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        for f in c.flatten() if pa.types.is_struct(c.type) else [c]:
            if pa.types.is_integer(f.type):
                own = np.unique(f.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            else:
                words = f.dictionary_encode()
                place = np.empty(len(words.dictionary), np.int64)
                place[pc.sort_indices(words.dictionary).to_numpy()] = np.arange(len(place))
                own = place[words.indices.to_numpy()]
            out = np.unique(out * (int(own.max(initial=0)) + 1) + own, return_inverse=True)[1]
    return out


def least_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of nodes 0 to n - 1 and edges (a, b): hooking by minimum and
    pointer jumping over whole arrays."""
    label = np.arange(n)
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def stars(edges: pa.Table) -> pa.RecordBatch:
    both = pa.chunked_array([*edges.column(0).chunks, *edges.column(1).chunks]).combine_chunks()
    if isinstance(both, pa.ChunkedArray):
        both = pa.concat_arrays(both.chunks)
    code = codes([both])
    at = np.zeros(int(code.max()) + 1, np.int64)
    at[code] = np.arange(len(code))
    label = least_reachable(code[: len(edges)], code[len(edges) :], len(at))
    below = np.flatnonzero(label != np.arange(len(at)))
    return pa.RecordBatch.from_arrays([both.take(pa.array(at[below])), both.take(pa.array(at[label[below]]))], names=["a", "b"])


def _settled(e: DataFrame) -> bool:
    """Every node has one edge upwards, or only edges from below: the edges are stars."""
    ends = e.select(F.col("a").alias("v"), F.lit(1).alias("up")).union(e.select("b", F.lit(0)))
    ends = ends.groupBy("v").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ends.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Link neighbours (large: the greater ones; small: the lesser ones and the node) to the least of them.

    The least neighbour comes from a hash aggregation, whose partial step shrinks a hub before the
    shuffle; the join back to the edges is an ordinary equi-join, which AQE splits where a hub is hot.
    """
    near = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = near.join(least, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()
