import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.llm import packing

TEXTS = [None, "", "one two three.", "one two three.", "don't I'LL 12ab é É ΣΑΣ İst x\x1cy <|endoftext|> 日本語 naïve!!..", "word " * 9000, "a b " * 1020 + "c", "tail"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "sequence") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "clash"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(3)


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def test_every_id_lies_in_one_piece_and_sequences_are_full(docs):
    rows = packing.harmonic_packing(docs, with_ids=True).collect()
    tok = tokenizer()
    by_seq: dict = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))] and sum(r.length for r in own) <= 2048
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        times = 2 if i == 2 else 1
        assert sorted([k for r in own for k in r.ids]) == sorted(ids * times) and {r.doc_tokens for r in own} == {len(ids)}
        if times == 1:
            assert [k for r in own for k in r.ids] == ids and [r.start for r in own] == [sum(x.length for x in own[:n]) for n in range(len(own))]
    assert sum(r.doc_id is None for r in rows) == 1


def test_reruns_agree_but_for_names_of_sequences(docs):
    a, b = (sorted(map(str, packing.harmonic_packing(docs).drop("sequence_id", "offset").collect())) for _ in range(2))
    assert a == b


def test_empty_table(docs):
    out = packing.harmonic_packing(docs.limit(0))
    assert out.count() == 0 and out.columns[-2:] == ["sequence_id", "offset"]


@given(st.integers(1, 20000), st.sampled_from([64, 100, 2048]), st.sampled_from([0.0, 0.004, 0.1]))
def test_cuts_add_up_and_fill_their_class(n, capacity, waste):
    cut = packing.cut_lengths(n, capacity, waste)
    assert sum(cut) == n and all(0 < c <= capacity for c in cut)
    assert sum(capacity // (capacity // c) - c for c in cut) <= max(1, waste * n) + len(cut)


def test_little_padding_when_there_is_much_to_pack(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', cast(50 + pmod(id * 7919, 3000) as int))").alias("text"))
    fill = packing.harmonic_packing(docs).groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.sum("n"), F.count("n")).first()
    assert fill[0] / (2048 * fill[1]) > 0.98


@pytest.mark.parametrize("worker_rows", [50, 3000, 50_000])
def test_sequences_of_many_workers_and_levels_stay_whole(spark, worker_rows):
    """Many workers, several levels of left-overs, the shortest class among them, and rows alike in all columns."""
    length = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, 700).otherwise(1 + F.col("id") % 2048)
    cut = spark.range(12_000).select((F.col("id") % 5).alias("doc_id"), F.lit(0).cast("long").alias("start"), length.cast("long").alias("length"), F.col("id").alias("ids_crc32"), F.lit(9).cast("long").alias("doc_tokens"))
    rows = packing.pack(cut, worker_rows=worker_rows).toPandas().sort_values(["sequence_id", "offset"])
    assert len(rows) == 12_000 and rows.ids_crc32.is_unique
    own = rows.groupby("sequence_id")
    assert own.length.sum().max() <= 2048
    assert (rows.offset == own.length.cumsum() - rows.length).all()
    assert rows.length.sum() / (2048 * own.ngroups) > 0.6


def test_encoder_agrees_with_the_tokenizer_on_any_text():
    import pyarrow as pa

    from strandline.llm.textbytes import chunks

    tok = tokenizer()
    rng = np.random.default_rng(3)
    letters = np.array(list("aBé ÉßÀ×÷'1 2\t\n.,!<|>endoftext日本\x1c\u0301\u00a0 Σςİstllre-_@#"))
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 60, 2000)] + ["<|startoftext|>", "", "we'll l'homme", "\xff \xdf"]
    encoder = packing.encoder(__import__("public_tokenizers").path("word_bpe_49k.json"))
    got: list = []
    for _, _, data, offsets in chunks(pa.array(texts), 4096):
        ids, at = encoder.encode(data, offsets)
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
