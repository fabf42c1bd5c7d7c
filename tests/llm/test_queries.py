"""Registered queries: oracle parity, whole results, the driver's contract."""
import importlib

import duckdb
import pytest

from tidewater.llm.queries import ORACLE, QUERIES
from tidewater.plans.verify import rows_of

from .conftest import SF

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[key](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == rows_of(cols, cur.fetchall())


def test_one_query_per_operator():
    assert [sum(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 14)] == [1] * 13
    entry = importlib.import_module("__spark_entry__")
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k.split("_")[0] in ("op2", "op3", "op8", "op9")))
def test_one_row_per_document(spark, key):
    ids = [r["doc_id"] for r in QUERIES[key](spark, SF).select("doc_id").collect()]
    docs = [r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(docs)
