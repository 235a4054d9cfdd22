"""Line dedup against a plain loop: nulls, ties, repeated rows, clashing columns, runs of several levels."""

import duckdb
import pytest

from strandline.llm import linededup, queries, sql
from tests.llm.test_sql import rows


def plain(docs, least_chars=20, least_docs=3):
    lower = str.maketrans(linededup.UPPER, linededup.LOWER)
    key = lambda s: s.strip(linededup.SPACE).translate(lower)
    held: dict = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        stay = [s for s in lines if len(held.get(key(s), ())) < least_docs or i == max(x for x in held[key(s)] if x is not None)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


A, B, C = "the first common line", "  Second Common LINE of some\t", "Ünïcode LINE of exactly 20 pts"[:20]
DOCS = [(i, "\n".join(([A] if i % 2 else []) + ([B.strip() if i % 3 else B, f"own line number {i} of this text"]) + ["short", ""] * (i % 4))) for i in range(40)] + [
    (100, f"{A}\n{A.upper()}\n\x0b{A}\x0c\nlast of its key"),
    (50, f"{A}\nanother text of one id"),
    (50, f"other row of one id with {A}\n{A}"),
    (51, "held by two documents only!!\nx"),
    (52, "held by two documents only!!"),
    (53, "twice in one row, that is one\n" * 5),
    (54, C), (55, C), (56, C), (54, C),
    (57, None), (58, ""), (None, A), (None, "\n" * 3), (59, "\r\n" + A + "\r\n" + "y" * 50_000),
    (60, "\n".join([B] * 3000)),
]


@pytest.mark.parametrize("batches,fanout", [(1, 3), (4, 2), (9, 2)])
def test_kept_lines_are_those_of_a_loop(spark, batches, fanout):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    got = linededup.dedup_lines(docs, batches=batches, fanout=fanout).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got), key=repr) == plain(DOCS)
    assert [r.text for r in got if r.doc_id == 57] == [None]


def test_lines_by_sql(spark):
    c = duckdb.connect()
    c.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", DOCS)
    want = sorted(tuple(r[:3]) for r in c.sql(sql.LINES).fetchall() if r[0] is not None)
    assert want == sorted(r[:3] for r in plain(DOCS) if r[0] is not None)


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, A + "\nz", "x", 7, i) for i in range(3)], "doc_id long, text string, n_lines string, `a.b` int, owner long")
    got = linededup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines_", "n_dropped"]
    assert sorted(map(tuple, got.collect())) == [(0, "z", "x", 7, 0, 2, 1), (1, "z", "x", 7, 1, 2, 1), (2, A + "\nz", "x", 7, 2, 2, 0)]
    assert linededup.dedup_lines(docs.limit(0)).count() == 0
    assert linededup.dedup_lines(spark.createDataFrame([(None, None), (1, None)], "doc_id long, text string")).count() == 2


def test_runs_are_gone_at_the_end(spark):
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_query(spark):
    got = queries.op12_line_runs(spark, "/root/testdata/sf0.001")
    c = duckdb.connect()
    c.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = c.sql(sql.LINES)
    assert rows(map(tuple, got.select(*want.columns).collect())) == rows(want.fetchall())
