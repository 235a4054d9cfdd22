"""Queries with SQL give DuckDB's rows, over the tables and over quoting, licensed and linked fixtures."""

import duckdb
import pytest

from strandline.llm import licenses, queries, quotes, sql

SF = "/root/testdata/sf0.001"


def rows(it):
    plain = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(plain(v) for v in r) for r in it), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_are_those_of_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = c.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns)
    assert rows(map(tuple, got.collect())) == rows(want.fetchall())


def test_quotes_by_sql(spark):
    data = [(1, 0, "u", "Hello there.\nHow are you?"), (1, 1, "a", "> Hello   there!\n> How are you\n\nFine."), (2, 0, "u", "other"), (2, 1, "u", ">> Hello there.\n> Fine.\nNice"), (5, 3, "u", "> Nice\nup"), (5, 4, "u", "then"), (3, 0, "u", None)]
    c = duckdb.connect()
    c.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    c.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", data)
    want = c.sql(sql.QUOTES)
    got = quotes.linked(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).select(*want.columns)
    assert rows(map(tuple, got.collect())) == rows(want.fetchall())


def test_licenses_by_sql(spark):
    data = [(1, "Released under the MIT License. cc by, CC-BY"), (2, None), (3, "x permission is hereby granted, free of any charge, to any person obtaining copy of this software and associated docs files"), (4, "all rights. Reserved general public license")]
    c = duckdb.connect()
    c.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", data)
    want = c.sql(sql.LICENSES)
    got = licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).select(*want.columns)
    assert rows(map(tuple, got.collect())) == rows(want.fetchall())
