"""The pipeline against a plain walk through its decisions."""

import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from strandline.functions.staging import staged
from tests.llm.test_text_operators import brute_groups, plain_base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, None, "src0", None), (90002, "12 34 !!", None, "src0", 8), (90003, "", "en", None, 0)], docs.schema)
    out = [staged(docs.union(extra).union(docs.limit(2)))]
    for _, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF)))
    return out


def test_columns_and_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixture", "packing"]
    for df in steps[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_drops_only_what_has_none(steps):
    gone = steps[0].select("doc_id").exceptAll(steps[1].select("doc_id"))
    ids = {r.doc_id for r in gone.collect()}
    assert {90001, 90002, 90003} <= ids and len(ids) <= 4


def test_one_document_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    groups = brute_groups(dict(rows).items(), 5, 80)
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted({c for _, c in groups.values()})


def test_personal_data_is_gone_and_the_rest_stays(steps):
    before = {r.doc_id: r.text for r in steps[2].collect()}
    for r in steps[3].collect():
        base = plain_base(before[r.doc_id])
        for _, a, b in base:
            assert before[r.doc_id][a:b] not in r.text or not base
        if not base:
            assert r.text == before[r.doc_id] or "<" in r.text
        assert not plain_base(r.text)


def test_mixture_takes_words_by_source(steps):
    words = lambda df: {r[0]: r[1] for r in df.groupBy("source").agg(F.sum(F.expr(r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"))).collect()}
    before, after = words(steps[3]), words(steps[4])
    assert all(after[s] <= 2 * before[s] for s in after) and abs(sum(after.values()) - 1.5 * sum(before.values())) <= len(before)


def test_packed_pieces_are_the_documents(steps):
    from tests.llm.test_packing import tokenizer

    tok = tokenizer()
    want = sorted(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in steps[4].collect())
    pieces = steps[5].collect()
    assert sum(want) == sum(r.length for r in pieces)
    whole = {zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in [*tok.encode(r.text, add_special_tokens=False).ids, 1])) for r in steps[4].collect()}
    assert {r.ids_crc32 for r in pieces if r.length == r.doc_tokens} <= whole


def test_it_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in entry.queries() if q.startswith("op") and q[2].isdigit()}
    assert corpus_pipeline.run(spark, SF).count() > 100
