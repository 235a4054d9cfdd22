"""Segments in order along their lines and rings: list ranking by pointer doubling, short stretches first.

A task chains the segments of its tiles, a chunk at a time, into strands by doubling pointers over whole arrays. The
strands, one row each, are then ranked across tasks by the same doubling as joins: in each round a strand's pointer
skips as far as the pointer that it points at, so the rounds grow with the logarithm of the strands of the longest
line. What still points on after enough rounds to have seen every strand is a ring; it is cut at its least vertex
and ranked once more. No task holds a line.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.staging import staged, unstage
from strandline.operators.graph import codes

#: Segments that a task chains at a time: some 400 bytes of memory each.
CHUNK = 1 << 18

HEAD = ["scene_id", "hr", "hc"]


def local_strands(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment that begins its strand, place in it, whether the strand is a ring) of segments from vertex ``start``
    to vertex ``end``, each vertex at most once in either. A ring begins at its least vertex."""
    n = len(start)
    at = np.full(int(max(start.max(), end.max())) + 1, -1)
    at[start] = np.arange(n)
    before = np.full(n, -1)
    after = at[end]
    before[after[after >= 0]] = np.flatnonzero(after >= 0)
    rounds = max(1, math.ceil(math.log2(n + 1)))

    def ranked() -> tuple[np.ndarray, np.ndarray]:
        head, place = np.where(before >= 0, before, np.arange(n)), (before >= 0).astype(np.int64)
        for _ in range(rounds):
            place, head = place + place[head], head[head]
        return head, place

    head, place = ranked()
    ring = before[head] >= 0
    if ring.any():
        least, back = start.copy(), np.where(ring, before, np.arange(n))
        for _ in range(rounds):
            least, back = np.minimum(least, least[back]), back[back]
        before[ring & (start == least)] = -1
        head, place = ranked()
    return head, place, ring


def _strands(chunk: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def chained() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            s, r0, c0, r1, c1 = (pa.concat_arrays(c.chunks) for c in t.columns)
            twice = lambda x, y: pa.concat_arrays([x, y])
            code = codes([twice(s, s), twice(r0, r1), twice(c0, c1)])
            head, place, ring = local_strands(code[: len(s)], code[len(s) :])
            h = pa.array(head)
            return pa.RecordBatch.from_arrays([s, r0, c0, r1, c1, r0.take(h), c0.take(h), pa.array(place), pa.array(ring)], names=["scene_id", "r0", "c0", "r1", "c1", "hr", "hc", "k", "ring"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, chunk - n))
                at += held[-1].num_rows
                n += held[-1].num_rows
                if n == chunk:
                    yield chained()
                    held, n = [], 0
        if held:
            yield chained()

    return task


def _doubled(strands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ranked, rings): strands (scene_id, hr, hc, n, low, pr, pc) that end somewhere, with ``ahead``, their segments
    up to the end, and ``last`` = (lr, lc), the end's strand; and those that never end, with ``low`` over the ring."""
    t = staged(strands.select(*HEAD, "pr", "pc", F.col("n").alias("ahead"), "low", F.col("hr").alias("lr"), F.col("hc").alias("lc")))
    rounds = math.ceil(math.log2(max(t.count(), 1))) + 1
    for _ in range(rounds):
        if t.where("pr is not null").isEmpty():
            break
        far = t.select("scene_id", F.col("hr").alias("pr"), F.col("hc").alias("pc"), F.col("pr").alias("_pr"), F.col("pc").alias("_pc"), F.col("ahead").alias("_ahead"), F.col("low").alias("_low"), F.col("lr").alias("_lr"), F.col("lc").alias("_lc"))
        step = t.where("pr is not null").join(far.hint("merge"), ["scene_id", "pr", "pc"])
        step = step.select(*HEAD, F.col("_pr").alias("pr"), F.col("_pc").alias("pc"), (F.col("ahead") + F.col("_ahead")).alias("ahead"), F.least("low", "_low").alias("low"), F.col("_lr").alias("lr"), F.col("_lc").alias("lc"))
        after = staged(step.unionByName(t.where("pr is null")))
        unstage(t)
        t = after
    return t.where("pr is null"), t.where("pr is not null")


def ordered(segs: DataFrame, tile: int = 256, chunk: int = CHUNK) -> DataFrame:
    """segs (scene_id, r0, c0, r1, c1: doubled pixel coordinates) with ``low`` = (r, c), the least vertex of the
    line, ``seq``, the segment's place from 0, ``length``, the line's segments, and ``ring``.

    A vertex has at most one segment that leaves it and one that comes, as contours have. A ring begins at its least
    vertex, an open line where nothing comes from. An empty table gives an empty one.
    """
    at = lambda c: F.floor(F.col(c) / (2 * tile))
    kind = segs.schema["scene_id"].dataType.simpleString()
    near = segs.select("scene_id", *[F.col(c).cast("long").alias(c) for c in ("r0", "c0", "r1", "c1")]).repartition("scene_id", at("r0"), at("c0"))
    own = staged(near.mapInArrow(_strands(chunk), f"scene_id {kind}, r0 long, c0 long, r1 long, c1 long, hr long, hc long, k long, ring boolean"))
    vertex = F.struct(F.col("r0").alias("r"), F.col("c0").alias("c"), "hr", "hc", "k")
    tail = F.max_by(F.struct("r1", "c1"), "k").alias("tail")
    strands = own.groupBy(*HEAD).agg(F.count(F.lit(1)).alias("n"), tail, F.min(vertex).alias("low"), F.bool_or("ring").alias("ring"))
    strands = staged(strands)
    # the end of an open line may be its least vertex; it is no place where a ring can be cut
    end = F.struct(F.col("tail.r1").alias("r"), F.col("tail.c1").alias("c"), F.lit(None).cast("long").alias("hr"), F.lit(None).cast("long").alias("hc"), F.lit(None).cast("long").alias("k"))
    heads = strands.where("not ring").select("scene_id", F.col("hr").alias("pr"), F.col("hc").alias("pc"))
    open_ = strands.where("not ring").withColumns({"_r": F.col("tail.r1"), "_c": F.col("tail.c1")})
    linked = open_.join(heads.hint("merge"), (open_["scene_id"] == heads["scene_id"]) & (open_["_r"] == heads["pr"]) & (open_["_c"] == heads["pc"]), "left").select(open_["*"], "pr", "pc")
    linked = staged(linked.withColumn("low", F.when(F.col("pr").isNull(), F.least("low", end)).otherwise(F.col("low"))).drop("_r", "_c", "tail"))
    ended, rings = _doubled(linked)
    lines = [ended.select(*HEAD, "ahead", "low", "lr", "lc", F.lit(False).alias("ring"))]
    if not rings.isEmpty():
        whole = rings.select(*HEAD, F.col("low").alias("_low"))
        cut = linked.join(whole.hint("merge"), HEAD)
        here = (F.col("pr") == F.col("_low.hr")) & (F.col("pc") == F.col("_low.hc"))
        cut = cut.withColumns({"low": F.col("_low"), "pr": F.when(~here, F.col("pr")), "pc": F.when(~here, F.col("pc"))}).drop("_low")
        again, left = _doubled(cut)
        if not left.isEmpty():
            raise RuntimeError("a vertex has several segments that leave it or come")
        lines.append(again.select(*HEAD, "ahead", "low", "lr", "lc", F.lit(True).alias("ring")))
    rank = lines[0] if len(lines) == 1 else lines[0].unionByName(lines[1])
    total = rank.groupBy("scene_id", "lr", "lc").agg(F.max("ahead").alias("length"), F.min("low").alias("low"))
    rank = rank.drop("low").join(total.hint("merge"), ["scene_id", "lr", "lc"]).select(*HEAD, (F.col("length") - F.col("ahead")).alias("offset"), "length", "low", "ring")
    closed = strands.where("ring").select(*HEAD, F.lit(0).cast("long").alias("offset"), F.col("n").alias("length"), "low", "ring")
    rank = staged(rank.unionByName(closed))
    unstage(strands, linked)
    place = F.col("offset") + F.col("k")
    seq = F.when(F.col("ring"), F.pmod(place - F.coalesce("low.k", F.lit(0)), "length")).otherwise(place)
    out = own.drop("ring").join(rank.hint("merge"), HEAD)
    return out.select("scene_id", "r0", "c0", "r1", "c1", F.struct("low.r", "low.c").alias("low"), seq.alias("seq"), "length", "ring")
