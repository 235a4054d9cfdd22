"""Whole texts as UTF-8 byte arrays: numpy helpers for Arrow batches inside tasks.

Every function works on a *chunk*: some consecutive rows of a batch, at most ``CHUNK_ROWS`` and ``CHUNK_BYTES`` of text
(a longer text is a chunk of its own), so that memory is bounded by the longest text, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 2048



def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session, where it has Spark's default of 64 MB for Arrow batches, from now on takes 4 MB.

    A task holds several batches of texts at once, in the JVM and in Python.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key).lower() in ("67108864b", "67108864", "64m", "64mb"):
        conf.set(key, "4m")
    return df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (Steele, Lea, Flood 2014) on uint64, wrapping."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) by chunk; a null text is an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        j = min(j, n, i + CHUNK_ROWS)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return _LOWER[data]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of ``inside`` bytes; runs end where a row ends."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(n, bool)
    heads = offsets[:-1][offsets[:-1] < n]
    first[heads] = True
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~prev | first))
    last = np.zeros(n, bool)
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = True
    nxt = np.empty(n, bool)
    nxt[-1] = False
    nxt[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~nxt | last)) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def space_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as (start, end, row)."""
    return spans(~_SPACE[data], offsets)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: a polynomial over seeded byte values, then mixed."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * power[: len(data)], out=total[1:])
    return mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
