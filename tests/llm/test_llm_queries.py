"""The registered queries against their SQL and against the libraries, on the smallest given tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from tidemark.llm import oracles, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", oracles.all_sql())
def test_query_equals_its_sql(spark, name):
    frame = queries.all_queries()[name](spark, SF)
    base = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    columns = sorted(frame.columns)
    want = base.sql(oracles.all_sql()[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in frame.collect()) == Counter(tuple(r[i] for i in order) for r in want.fetchall())


@pytest.mark.parametrize("name", [n for n in queries.all_queries() if n not in oracles.all_sql() and n != "op11_whitening"])
def test_query_has_a_row_for_each_document(spark, name):
    got = Counter(r.doc_id for r in queries.all_queries()[name](spark, SF).select("doc_id").collect())
    assert got == Counter(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
