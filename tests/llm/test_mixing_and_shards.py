import re

import pytest
from pyspark.sql import functions as F

from strandline.llm import mixing, order, shards


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), "hot" if i % 3 else f"s{i % 5}", 1, 2) for i in range(600)]
    rows += [(700, None, "hot", 1, 2), (701, "", None, 1, 2), (702, " a\tb\x0bc\n", None, 1, 2), (703, "a", None, 1, 2), (703, "a", None, 1, 2), (None, "x y", "only", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, taken int")


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            target |= {s: left * w[s] / total for s in open_}
            break
        target |= {s: most * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_sources_meet_their_targets(docs, monkeypatch):
    monkeypatch.setattr(order, "RANGE_ROWS", 50)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken = {}, {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    want = water_fill(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(taken[s] == round(want[s]) for s in sizes)


def test_order_is_random_by_key_and_reruns_agree(docs):
    a, b = (sorted(map(str, mixing.mix(d).collect())) for d in (docs, docs.repartition(7)))
    assert a == b


def test_mixed_rows_are_the_words_taken(docs):
    plan = {}
    for r in mixing.mix(docs).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.taken
    got = {}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {k: v for k, v in plan.items() if v}


def test_empty(docs):
    e = docs.limit(0)
    assert mixing.mix(e).count() == 0 and mixing.mixed_rows(e).count() == 0 and shards.interleave(e).count() == 0


@pytest.mark.parametrize("ranges", [50, 10_000])
def test_shards_are_even_and_match_the_mixture(docs, monkeypatch, ranges):
    monkeypatch.setattr(order, "RANGE_ROWS", ranges)
    rows = shards.interleave(docs).collect()
    n = docs.count()
    assert len(rows) == n
    by: dict = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(24)) and {len(v) for v in by.values()} <= {n // 24, -(-n // 24)}
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        # at any place a source is within a row of its share, and so each of the nine moves the cut a little
        assert abs(sum(r.source == "hot" for r in own) - 401 / 24) <= 4
    x = next(r for r in rows if r.doc_id == 701)
    assert (x.size, x.text_crc32, x.law, x.grown_shard) == (8, 0, "rows", None)


def test_shards_on_disk(docs, spark, tmp_path):
    shards.write_shards(docs.where("doc_id is not null"), str(tmp_path / "s"), shards=4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() - 1 - 0 and back.select("shard").distinct().count() == 4


def test_prefix_sums_match_a_plain_count(spark):
    rows = spark.range(1000).withColumn("g", F.col("id") % 3).withColumn("k", order.random_key(1, "id"))
    got = order.prefix(rows, 50 * order.RANGE_ROWS, ["g"], F.col("k") / F.lit(2.0**63), ["k"], before="1", s="id").collect()
    for g in range(3):
        own = sorted((r for r in got if r.g == g), key=lambda r: r.k)
        assert [r.before for r in own] == list(range(len(own))) and own[-1].s + own[-1].id == own[-1].s_all


def test_shard_order_is_that_of_a_plain_ranking(docs, spark):
    """Keys and phases from Spark's hash; ranks, places, order, shards and slots by hand."""
    from strandline.llm.order import random_key

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", F.crc32(text).alias("crc"), random_key(7919, F.xxhash64(text)).alias("key"), (random_key(7920, F.coalesce("source", F.lit("")), F.col("source").isNull()) / F.lit(2.0**63)).alias("phase"), (F.octet_length(text) + 8).alias("size")).collect()
    low = lambda x: -(2**63) if x is None else x
    placed = []
    for source in {r.source for r in rows}:
        own = sorted((r for r in rows if r.source == source), key=lambda r: (r.key, low(r.doc_id), r.crc, r.size))
        placed += [(min((i + r.phase) / len(own), 1 - 2.0**-53), source or "", source is None, r.key, low(r.doc_id), r) for i, r in enumerate(own)]
    placed.sort(key=lambda p: p[:5])
    n, want = len(placed), {}
    for at, p in enumerate(placed):
        shard = at * 24 // n
        want.setdefault((p[5].doc_id, p[5].crc), []).append((shard, at - -(-shard * n // 24)))
    got: dict = {}
    for r in shards.interleave(docs).collect():
        got.setdefault((r.doc_id, r.text_crc32), []).append((r.shard, r.slot))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_equal_texts_of_a_source_stay_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = shards.interleave(docs)
    groups = rows.groupBy("source", "text_crc32").agg(F.count("shard").alias("n"), F.countDistinct("shard").alias("shards")).where("n between 2 and 20").collect()
    # a group of n rows of a source is parted by one of 23 cuts at most
    assert len(groups) > 50 and sum(g.shards > 1 for g in groups) <= 0.1 * len(groups) and max(g.shards for g in groups) <= 2
    across = rows.groupBy("text_crc32").agg(F.count("shard").alias("n"), F.countDistinct("shard").alias("shards")).where("n between 2 and 20").collect()
    assert sum(g.shards > 1 for g in across) <= 0.5 * len(across), (sum(g.shards > 1 for g in across), len(across))
