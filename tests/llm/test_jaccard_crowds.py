"""Crowds of texts round one boilerplate: links are those of all pairs, and candidate pairs do not grow with the square."""

import numpy as np
import pytest

from strandline.llm import jaccard


def family(rng, n, common, own, copies):
    """Texts of ``common`` shared and ``own`` words of their own, then near copies of the first ones."""
    head = " ".join(f"c{k}" for k in range(common))
    texts = [head + " " + " ".join(f"w{i}x{k}" for k in range(own)) for i in range(n)]
    for i in range(copies):
        words = texts[i].split(" ")
        for k in rng.choice(len(words), 1 + i % 4, replace=False):
            words[k] = f"z{i}z{k}"
        texts.append(" ".join(words))
    return texts


def plain(texts, width, percent):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({" ".join(w[i : i + width]) for i in range(len(w) - width + 1)})
    where: dict = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    same = np.zeros((len(sets), len(sets)), int)
    for own in where.values():
        same[np.ix_(own, own)] += 1
    size = np.array([len(s) for s in sets])
    linked = 100 * same >= percent * (size[:, None] + size[None] - same)
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None], len(sets)).min(1)
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize("common,own,n", [(150, 60, 700), (180, 24, 500)])
def test_crowds(spark, monkeypatch, common, own, n):
    rng = np.random.default_rng(common)
    texts = family(rng, n, common, own, 60) + family(rng, 5, common, 1, 0)
    tested = []
    verify = jaccard._verified

    def counted(pairs, *rest):
        pairs = jaccard.staged(pairs)
        tested.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(jaccard, "_verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs, 4, 85).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 4, 85)
    assert sum(tested) <= 20 * len(texts)


def test_small_crowds(spark):
    rng = np.random.default_rng(2)
    texts = []
    for k in range(12):
        base = [f"b{k}w{i}" for i in range(int(rng.integers(20, 90)))]
        for _ in range(9):
            words = list(base)
            for i in rng.choice(len(words), int(rng.integers(0, 4)), replace=False):
                words[i] = f"r{rng.integers(1 << 30)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for width, percent in ((4, 85), (5, 80), (1, 70)):
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs, width, percent).collect()}
        assert [got[i] for i in range(len(texts))] == plain(texts, width, percent)


def test_common_passages_make_no_crowd(spark, monkeypatch):
    """Texts that have some passages in common, but far too few for a link, are left out before their sets are read."""
    rng = np.random.default_rng(6)
    passages = [" ".join(f"p{k}x{i}" for i in range(8)) for k in range(40)]
    texts = []
    for k in range(200):
        parts = [" ".join(f"t{k}x{j}y{i}" for i in range(28)) for j in range(12)]
        texts.append(" ".join(x for own, p in zip(parts, rng.choice(40, 12, replace=False), strict=True) for x in (own, passages[p])))
    for k in range(20):
        words = texts[k].split(" ")
        for i in rng.choice(len(words), k % 6, replace=False):
            words[i] = f"z{k}z{i}"
        texts.append(" ".join(words))
    crowds = []
    pairs = jaccard._prefix_pairs

    def counted(crowd, *rest):
        crowds.append(crowd.count())
        return pairs(crowd, *rest)

    monkeypatch.setattr(jaccard, "_prefix_pairs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs, 4, 85).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 4, 85)
    assert sum(crowds) <= 20


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_similar_sets_share_as_many_signatures_as_needed(percent):
    rng = np.random.default_rng(percent)
    for n in [1, 3, 7, 9, 14, 22, 30, 51, 77, 150, 333, 1400]:
        for _ in range(40):
            x = rng.integers(0, 2**63, n, dtype=np.uint64)
            most = 2 * n * (100 - percent) // (100 + percent)
            gone = int(rng.integers(0, most // 2 + 1))
            y = np.concatenate([x[gone:], rng.integers(0, 2**63, int(rng.integers(0, most - gone + 1)), dtype=np.uint64)])
            u = len(set(x) | set(y))
            if not len(y) or 100 * (n - gone) < percent * u or set(x) == set(y):
                continue
            both, at = np.concatenate([np.sort(x), np.sort(y)]), np.array([0, n, n + len(y)])
            row, sig = jaccard.signatures(both, at, percent)
            common = np.array(list(set(sig[row == 0]) & set(sig[row == 1])))
            enough = [(common < 0).sum(), (common >= 0).sum()][::-1] >= jaccard.needs(both, at, percent)
            assert enough.any(1).all(), (n, len(y), gone)
