"""Search for whole documents: long queries, many at once."""

from __future__ import annotations

import compare
import pytest
from conftest import ODD, TESTDATA
from test_search import asked, brute, found  # noqa: F401

import __spark_entry__
from bazaar.llm import search as sr


def test_queries_are_documents_divisible_by_20(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TESTDATA}/documents.parquet'")
    name = "op1_document_search"
    got = __spark_entry__.queries()[name](spark, TESTDATA)
    assert compare.differences(got, con, __spark_entry__.oracle_sql()[name]) == []
    ids = {r[0] for r in con.execute("SELECT doc_id FROM documents WHERE doc_id % 20 = 0").fetchall()}
    assert {r.query_id for r in got.collect()} <= ids and len(ids) > 5


@pytest.mark.parametrize("cells", [1, 3000, 1 << 22])
def test_long_queries_equal_brute_force(documents, asked, prose, monkeypatch, cells):  # noqa: F811
    monkeypatch.setattr(sr, "SHARD_BYTES", 9000)
    monkeypatch.setattr(sr, "CELLS", cells)
    monkeypatch.setattr(sr, "LONG", 0)
    rows = [(i, f"{prose(1 + i % 70, i, 30)} {prose(1 + i % 9, -i, 3000)}") for i in range(200)]
    rows += [(900 - i, "w1 w2 same") for i in range(30)] + [*enumerate(ODD), (None, "one two"), (3, "one two")]
    queries = [(i, t) for i, t in rows if i is None or i % 20 == 0] + [(7, "absent"), (7, "W1 w1 w2"), (8, None)]
    assert found(documents(rows), asked(queries)) == brute(rows, queries)
    if cells > 1:
        assert found(documents(rows), asked(queries), query_bytes=900, top=3) == brute(rows, queries, 3)
