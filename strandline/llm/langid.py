"""Language identification by multilingual mixture inference (operator 7).

A document is a mixture of languages: each stretch of it (a window of some words) comes from one language,
and expectation-maximisation over the windows' n-gram likelihoods estimates the proportions. Which
languages are in it at all is chosen by likelihood less a penalty for each language, dropping the weakest
while that pays; the prediction is the largest share.

Likelihoods are those of hashed byte 4-grams of lower-cased letters, smoothed, learned from a bounded
sample of labelled documents (``per_language`` of the lowest hashes for each language).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.order import random_key
from strandline.llm.textbytes import chunks, small_batches

BITS = 16
#: Bits of the bins that hashes are counted in.
HASH_BITS = 16
WINDOW_GRAMS = 48
PENALTY = 12.0
ROUNDS = 12

# Letters outside ASCII are told from other characters by Unicode, through one table of the first plane;
# every higher code point counts as a letter if Python says so, see _letters.
_TABLE: list[np.ndarray] = []


def _points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a chunk and the rows' offsets in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, lead[offsets]


def _letters() -> np.ndarray:
    """For each code point below 0x110000: its lower-case code point if it is a letter, else 0 (built once a worker)."""
    if not _TABLE:
        t = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low[0])
        _TABLE.append(t)
    return _TABLE[0]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each 4-gram, row offsets in them): one for each letter, over letters and word gaps.

    The gram of a letter is it and the three characters before it, where anything but a letter is a gap
    and gaps in a row are one.
    """
    points, at = _points(data, offsets)
    low = _letters()[points]
    n = len(low)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    head = np.zeros(n, bool)
    head[at[:-1][at[:-1] < n]] = True
    gap = low == 0
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    keep |= head
    y, h = low[keep].astype(np.uint64), head[keep]
    pos = np.flatnonzero(h)
    since = np.arange(len(y)) - np.repeat(pos, np.diff(np.append(pos, len(y))))
    code = y.copy()
    for k, mul in ((1, 0x9E3779B1), (2, 0x85EBCA77C2B2AE63), (3, 0x27D4EB2F165667C5)):
        b = np.zeros(len(y), np.uint64)
        b[k:] = np.where(since[k:] >= k, y[:-k], np.uint64(0)) if k < len(y) else b[k:]
        code += b * np.uint64(mul)
    code *= np.uint64(0x9E3779B97F4A7C15)
    hashed = (code >> np.uint64(64 - BITS)).astype(np.int32)
    letter = y > 0
    count = np.concatenate([[0], np.cumsum(letter)])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return hashed[letter], count[kept[at]]


def fit(labelled: DataFrame, per_language: int = 1500, seed: int = 5) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and log-likelihoods [2**BITS, languages] from ``labelled`` (doc_id, text, lang).

    Learns from ``per_language`` documents of each language at most, those of the lowest seeded hashes (and
    as many more as repeat the last one's id and text); null texts and labels are left out. What reaches the driver is a count for each n-gram hash and
    language: 2**BITS numbers for each language, whatever the input.
    """
    rows = labelled.where("lang is not null and text is not null").select("lang", "text", random_key(seed, "doc_id", F.xxhash64("text")).alias("_h"))
    # The lowest hashes: a first aggregation by (lang, bin of the hash) counts rows, and only bins up to the one
    # where the count is reached hold candidates; both tables are bounded by languages times bins.
    bins = rows.select("lang", "_h", F.shiftrightunsigned("_h", 63 - HASH_BITS).alias("_bin"))
    up = Window.partitionBy("lang").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    full = bins.groupBy("lang", "_bin").count().withColumn("_before", F.coalesce(F.sum("count").over(up), F.lit(0)))
    last = full.where(F.col("_before") < per_language).groupBy("lang").agg(F.max("_bin").alias("_last"), F.max(F.struct("_bin", (per_language - F.col("_before")).alias("take"))).alias("_end"))
    last = last.select("lang", "_last", F.col("_end.take").alias("_take"))
    # of the last bin the lowest hashes again; a hash that stands in several rows counts with all of them
    edge = bins.join(last, "lang").where("_bin = _last").groupBy("lang", "_h", "_take").count()
    edge = edge.withColumn("_before", F.coalesce(F.sum("count").over(Window.partitionBy("lang").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edge = edge.where("_before < _take").groupBy("lang").agg(F.max("_h").alias("_most"))
    # a row for each language: the rest is a filter of the scan
    most = {r["lang"]: r["_most"] for r in edge.collect()}
    if not most:
        return [], np.full((1 << BITS, 0), 0, np.float32)
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in most.items() for x in pair]), F.col("lang"))
    texts = rows.where(F.col("_h") <= limit).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, j, data, offsets in chunks(batch.column(1)):
                g, at = grams(data, offsets)
                for k in range(i, j):
                    own = sums.setdefault(langs[k], np.zeros(1 << BITS, np.int64))
                    own += np.bincount(g[at[k - i] : at[k - i + 1]], minlength=1 << BITS)
        for lang, c in sums.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(c[some])], names=["lang", "gram", "n"])

    counts = small_batches(texts).mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts.lang.unique())
    c = np.zeros((1 << BITS, len(langs)))
    for k, lang in enumerate(langs):
        own = counts[counts.lang == lang]
        c[own.gram.to_numpy(), k] = own.n.to_numpy()
    c += 0.05
    return langs, np.log(c / c.sum(0, keepdims=True)).astype(np.float32) if langs else c.astype(np.float32)


def _groups(x: np.ndarray, at: np.ndarray, op=np.add) -> np.ndarray:
    """Sums (or maxima) of x over the stretches of ``at``; an empty stretch gives 0."""
    out = np.zeros((len(at) - 1, *x.shape[1:]), x.dtype)
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some):
        out[some] = op.reduceat(x, at[:-1][some], axis=0)
    return out


def _em(ll: np.ndarray, at: np.ndarray, size: np.ndarray, use: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document, its windows weighted by ``size``.

    ll [windows, languages]: log-likelihoods; at: documents' offsets; use [documents, languages]: allowed.
    """
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    theta = use / np.maximum(use.sum(1, keepdims=True), 1)
    top = np.where(use[doc], ll, -np.inf).max(1)
    p = np.where(use[doc], np.exp(np.maximum(ll - top[:, None], -80)), 0.0)
    all_ = np.maximum(_groups(size, at), 1e-9)
    for _ in range(rounds):
        r = p * theta[doc]
        r /= np.maximum(r.sum(1, keepdims=True), 1e-300)
        theta = _groups(r * size[:, None], at) / all_[:, None]
    like = _groups(np.log(np.maximum((p * theta[doc]).sum(1), 1e-300)) + top, at)
    return theta, like


def proportions(g: np.ndarray, at: np.ndarray, table: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Each document's language proportions [documents, languages], after the choice of its languages."""
    n, langs = len(at) - 1, table.shape[1]
    counts = np.diff(at)
    windows = -(-counts // WINDOW_GRAMS)
    w_at = np.concatenate([[0], np.cumsum(windows)])
    doc = np.repeat(np.arange(n), windows)
    k = np.arange(w_at[-1]) - w_at[doc]
    # windows of a document as even as can be, so that none is a scrap
    start = at[doc] + k * counts[doc] // np.maximum(windows[doc], 1)
    edges = np.append(start, at[-1])
    ll = _groups(table[g].astype(np.float64), edges) if len(start) else np.zeros((0, langs))
    size = np.diff(edges).astype(np.float64)
    use = np.ones((n, langs), bool)
    theta, like = _em(ll, w_at, size, use)
    best, score = theta, like - penalty * langs
    live = np.flatnonzero(counts > 0)
    for _ in range(langs - 1):
        if not len(live):
            break
        weakest = np.where(use[live], theta[live], np.inf).argmin(1)
        use[live, weakest] = False
        sub = np.concatenate([[0], np.cumsum(windows[live])])
        pick = np.repeat(w_at[live] - sub[:-1], windows[live]) + np.arange(sub[-1])
        t, l = _em(ll[pick], sub, size[pick], use[live])
        theta[live] = t
        s = l - penalty * use[live].sum(1)
        better = s >= score[live]
        best = best.copy()
        best[live[better]] = t[better]
        score[live[better]] = s[better]
    return best


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, penalty: float = PENALTY, names: tuple[str, str, str] = ("lang_pred", "score", "proportions")) -> DataFrame:
    """The columns of ``docs`` with lang_pred, score and proportions (array, by ``langs``), or with the names given.

    Only the text is looked at. A text that is null or without a letter, and any text where nothing was
    learned, is ``und`` with score 0; ties go to the first language in order. Columns of ``docs`` named
    like those added give way to them.
    """
    own = [c for c in docs.columns if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(table)  # 2**BITS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            k = batch.schema.get_field_index("text")
            for i, j, data, offsets in chunks(batch.column(k)):
                part = batch.slice(i, j - i)
                g, at = grams(data, offsets)
                some = np.diff(at) > 0
                if langs:
                    theta = proportions(g, at, model, penalty)
                    theta[~some] = 0
                    win = theta.argmax(1)
                    score = np.clip(theta.max(1), 0, 1)
                    best = [langs[w] if s else "und" for w, s in zip(win, some, strict=True)]
                else:
                    theta, score, best = np.zeros((j - i, 0)), np.zeros(j - i), ["und"] * (j - i)
                shares = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * len(langs), pa.int32()), pa.array(theta.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best, pa.string()), pa.array(score), shares], names=[*part.schema.names, *names])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own]
    added = [f"`{n}` {kind}" for n, kind in zip(names, ("string", "double", "array<double>"), strict=True)]
    return small_batches(docs).select(*[F.col(f"`{c}`") for c in own]).mapInArrow(run, ", ".join([*fields, *added]))


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's decimal text leaves remainder 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
