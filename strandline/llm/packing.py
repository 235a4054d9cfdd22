"""Harmonic packing of token sequences (operator 1).

Pieces of a document fall into reciprocal-capacity classes: class k holds lengths in
``(C // (k + 1), C // k]`` and k of them always fit one sequence of C tokens, so each worker fills
the sequences of each class by counting, with no search for space and no word to other workers.
Documents may be cut, and the cuts are made where the classes want them: whole sequences first, then,
while the rest would leave more than ``waste`` of itself as padding, a piece of exactly ``C // (k + 1)``.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.staging import staged
from strandline.llm.textbytes import chunks, small_batches, space_words, word_hashes

CAPACITY = 2048
END_ID = 1

#: Units that a Python worker keeps with their ids; beyond it those met once go.
KNOWN_UNITS = 300_000
#: Bytes of text that are split and looked up together.
TEXT_BYTES = 1 << 20

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, doc_row long"

_WHITE, _LETTER, _DIGIT, _MARK, _ODD = range(5)


def _byte_kinds() -> np.ndarray:
    """The kind of each byte, where no byte before it decides."""
    kind = np.full(256, _ODD, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = _WHITE
    kind[33:127] = _MARK
    kind[48:58] = _DIGIT
    kind[97:123] = _LETTER
    kind[[39, 60]] = _ODD  # ' opens contractions, < special tokens
    return kind


_KIND = _byte_kinds()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class WordEncoder:
    """``word_bpe_49k.json`` through a table of units seen before.

    This tokenizer splits a text into runs of letters, single digits and runs of other marks, drops white
    space and joins nothing across these, so a text's ids are those of its units one after another. Units
    are found and looked up for many texts at once. White-space-separated stretches with anything but ASCII
    and Latin-1 letters, digits and plain marks are one unit, whose inside is left to the tokenizer.
    A unit is known by a 64-bit hash of its lower-cased bytes.
    """

    def __init__(self, path: str):
        # a task has one core: the library's thread pool would only wait on it, and burn time doing so
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # For lower-case Latin-1 letters and single spaces the normaliser and the split by pattern change
        # nothing: the same model with a plain split at spaces gives the same ids in less time.
        self.plain_model = Tokenizer(self.tokenizer.model)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)
        self.plain_model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        self._forget()

    def _forget(self) -> None:
        self.known = pd.Index(np.zeros(0, np.uint64))
        self.first, self.size, self.uses = (np.zeros(0, np.int32) for _ in range(3))
        self.pool = np.zeros(0, np.uint32)

    def _trim(self) -> None:
        """Keep the units met again since they were learned, or none if these are many."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > KNOWN_UNITS // 2:
            return self._forget()
        size = self.size[keep]
        until = np.cumsum(size) - size
        self.pool = self.pool[np.repeat(self.first[keep] - until, size) + np.arange(size.sum())]
        self.first, self.size, self.uses, self.known = until.astype(np.int32), size, np.ones(len(keep), np.int32), self.known[keep]

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        got = [np.asarray(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return (np.concatenate(got) if got else self.pool[:0]), np.array([len(g) for g in got], np.int64)

    def _letter_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of letters, many to a call: each of them ends with an end-of-word id."""
        calls = [" ".join(words[i : i + 200]) for i in range(0, len(words), 200)]
        got = [np.asarray(e.ids, np.uint32) for e in self.plain_model.encode_batch_fast(calls, add_special_tokens=False)]
        ids = np.concatenate(got) if got else self.pool[:0]
        return ids, np.diff(np.concatenate([[-1], np.flatnonzero(self.ends[ids])]))

    def _learn(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, letters: np.ndarray, keys: np.ndarray) -> None:
        text = low.tobytes()
        for of, ids in ((letters, self._letter_ids), (~letters, self._ids)):
            got, size = ids([text[a:b].decode("utf-8", "replace") for a, b in zip(start[of].tolist(), end[of].tolist(), strict=True)])
            self.first = np.concatenate([self.first, (len(self.pool) + np.cumsum(size) - size).astype(np.int32)])
            self.size = np.concatenate([self.size, size.astype(np.int32)])
            self.uses = np.concatenate([self.uses, np.zeros(len(size), np.int32)])
            self.pool = np.concatenate([self.pool, got])
            self.known = self.known.append(pd.Index(keys[of]))

    @staticmethod
    def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The units of a chunk of texts: its bytes in lower case, and start, end, row and kind of each unit."""
        low = _LOWER[data]
        kind = _KIND[low]
        pair = np.flatnonzero(low[:-1] == 0xC3)  # U+00C0 to U+00FF; all but the signs of times and division are letters
        pair = pair[(low[pair + 1] != 0x97) & (low[pair + 1] != 0xB7)]
        kind[pair] = kind[pair + 1] = _LETTER
        upper = pair[low[pair + 1] < 0x9F] + 1
        low[upper] += 32
        odd = kind == _ODD
        if odd.any():
            start, end, _ = space_words(data, offsets)
            n = np.concatenate([[0], np.cumsum(odd)])
            whole = n[end] > n[start]
            mark = np.zeros(len(data) + 1, np.int64)
            mark[start[whole]] += 1
            mark[end[whole]] -= 1
            kind[np.cumsum(mark[:-1]) > 0] = _ODD
        new = np.empty(len(kind), bool)
        new[:1] = True
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        new[offsets[:-1][offsets[:-1] < len(kind)]] = True
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(kind))
        some = kind[at] != _WHITE
        start, end = at[some], end[some]
        return low, start, end, np.searchsorted(start, offsets), kind[start]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each text of a chunk, one after another, and the texts' offsets in them."""
        if not len(data):
            return self.pool[:0], np.zeros(len(offsets), np.int64)
        low, start, end, rows, kind = self._units(data, offsets)
        keys = word_hashes(low, start, end)
        at = self.known.get_indexer(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.known) + len(new) > KNOWN_UNITS and len(self.known):
                self._trim()
                new = np.flatnonzero(self.known.get_indexer(keys) < 0)
            _, one = np.unique(keys[new], return_index=True)
            one = new[one]
            self._learn(low, start[one], end[one], kind[one] == _LETTER, keys[one])
            at = self.known.get_indexer(keys)
        self.uses += np.bincount(at, minlength=len(self.uses)).astype(np.int32)
        size = self.size[at]
        until = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        ids = self.pool[np.repeat(self.first[at] - until[:-1], size) + np.arange(until[-1])]
        return ids, until[rows]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut_lengths(n: int, capacity: int, waste: float) -> list[int]:
    """Lengths of the pieces of ``n`` tokens; their sum is n and none exceeds the capacity."""
    full, r = divmod(n, capacity)
    out = [capacity] * full
    while r:
        k = capacity // r
        room = capacity // k
        cut = capacity // (k + 1)
        if room - r <= waste * n or cut == 0:
            out.append(r)
            break
        out.append(cut)
        r -= cut
    return out


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, waste: float = 0.004, with_ids: bool = False) -> DataFrame:
    """Tokenise and cut each row of ``docs`` (doc_id, text): one row per piece, with its ids if asked for.

    A null text counts as empty and has the end id alone. A document that stands in several rows is cut
    once for each; doc_row, a number that each row gets, tells their pieces apart. Other columns are not read.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    tail = np.array([end_id], np.uint32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1), TEXT_BYTES):
                rows: list[tuple] = []
                ids, at = enc.encode(data, offsets)
                own_rows = zip(batch.column(0).slice(i, j - i).to_pylist(), batch.column(2).slice(i, j - i).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True)
                for doc_id, doc_row, a, b in own_rows:
                    own = np.concatenate([ids[a:b], tail])
                    n, start = len(own), 0
                    for length in cut_lengths(n, capacity, waste):
                        part = own[start : start + length]
                        rows.append((doc_id, start, length, zlib.crc32(part), n, doc_row, *([part.astype(np.int32)] if with_ids else [])))
                        start += length
                kinds = [pa.int64()] * 6 + [pa.list_(pa.int32())] * with_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "doc_row"] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return small_batches(docs).select("doc_id", "text", F.monotonically_increasing_id()).mapInArrow(cut, PIECE + ", ids array<int>" * with_ids)


def _numbered(level: int | Column, worker: Column, k: Column, bin_: Column) -> Column:
    """sequence_id of a sequence that a worker filled: level, worker, class and number there in one long."""
    return F.lit(level).cast("long") * 2**57 + worker.cast("long") * 2**29 + k.cast("long") * 2**17 + bin_.cast("long")


#: The level of the last handful, above all levels of workers; class 1 has ids from 2**62.
LAST_LEVEL = 31


def pack(cut: DataFrame, capacity: int = CAPACITY, worker_rows: int = 50_000) -> DataFrame:
    """Put pieces (columns of ``pieces``) into sequences; adds sequence_id and offset.

    Pieces are dealt by a hash of their row number to independent workers of about ``worker_rows`` rows,
    which fill the sequences of each class with k pieces. What a worker has left over (under k pieces of a
    class, so at most some ``capacity * ln(capacity)`` rows whatever it was dealt) goes to a next level of
    half as many workers or fewer, and so on; above ``2**27 * worker_rows`` pieces a worker has more rows.
    When one worker has had its turn, that handful is packed together, longest first, in one task whose input
    is bounded by the capacity alone. Class 1 needs no counting. Rows alike in all columns are packed apiece.
    An empty table gives an empty one.
    """
    if worker_rows > 60_000 or capacity > 4095:
        raise ValueError("at most 60,000 rows a worker and 4,095 tokens a sequence: a sequence's number has 17 bits, its class 12")
    columns = cut.columns
    rows = staged(cut.withColumn("_at", F.monotonically_increasing_id()).withColumn("k", F.floor(F.lit(capacity) / F.col("length")).cast("int")))
    out = rows.where("k = 1").select(*columns, (F.col("_at") + F.lit(2**62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rows = rows.where("k > 1")
    level, workers = 0, 2**28
    while True:
        # half as many as before at most, so levels end even where workers are dealt less than they leave over
        workers = max(1, min(rows.count() // worker_rows, workers // 2))
        own = Window.partitionBy("worker", "k")
        rows = rows.withColumn("worker", F.pmod(F.xxhash64(F.lit(level), "_at"), F.lit(workers)).cast("int"))
        rows = rows.withColumn("n", F.row_number().over(own.orderBy("length", "_at")) - 1).withColumn("bin", F.floor(F.col("n") / F.col("k")).cast("long"))
        rows = rows.withColumn("full", F.col("bin") < F.floor(F.count(F.lit(1)).over(own) / F.col("k")))
        slot = Window.partitionBy("worker", "k", "bin").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
        rows = staged(rows.withColumn("offset", F.coalesce(F.sum("length").over(slot), F.lit(0))))
        out = out.unionByName(rows.where("full").select(*columns, _numbered(level, F.col("worker"), F.col("k"), F.col("bin")).alias("sequence_id"), "offset"))
        rows = rows.where("not full").select(*columns, "_at", "k")
        if workers == 1:
            return out.unionByName(_last(rows.drop("k"), capacity).select(*columns, "sequence_id", "offset"))
        level += 1


def _last(rest: DataFrame, capacity: int) -> DataFrame:
    """First-fit decreasing over the left-overs of one worker: under k pieces for each of some 90 classes."""
    schema = rest.schema

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found).sort_by([("length", "descending"), ("_at", "ascending")])
        used: list[int] = []
        bins, at = [], []
        open_from, before = 0, None
        for n in table.column("length").to_pylist():
            # lengths fall, so a sequence without room for an equal one before has none for this one
            if n != before:
                open_from, before = 0, n
            b = next((i for i in range(open_from, len(used)) if used[i] + n <= capacity), len(used))
            open_from = b
            if b == len(used):
                used.append(0)
            bins.append(LAST_LEVEL * 2**57 + b)
            at.append(used[b])
            used[b] += n
        table = table.append_column("sequence_id", pa.array(bins, pa.int64())).append_column("offset", pa.array(at, pa.int64()))
        yield from table.to_batches()

    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", sequence_id long, offset long"
    return rest.repartition(1).mapInArrow(fit, out)


def harmonic_packing(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, waste: float = 0.004, with_ids: bool = False) -> DataFrame:
    """All of ``docs`` in sequences of at most ``capacity`` tokens: a row per piece.

    doc_id, start, length, ids_crc32, doc_tokens, doc_row, [ids,] sequence_id, offset.
    """
    return pack(pieces(docs, tokenizer_path, capacity, end_id, waste, with_ids), capacity)
