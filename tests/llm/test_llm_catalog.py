"""Queries of this subpackage against their SQL, the pipeline against its parts, and what the package imports."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from conftest import ROOT, TESTDATA
from geoingest.llm import catalog
from test_catalog import canonical

QUERIES, SQL = catalog.all_queries(), catalog.all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in TESTDATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(TESTDATA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = df.collect()
    assert got
    if name in SQL:
        expected = duck.execute(SQL[name])
        columns = [d[0] for d in expected.description]
        assert sorted(df.columns) == sorted(columns)
        assert canonical(df.columns, got) == canonical(columns, expected.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(str(TESTDATA / "documents.parquet"))
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, str(TESTDATA))
        assert out.columns == docs.columns, name
        at = out
    got = corpus_pipeline.run(spark, str(TESTDATA))
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(r["doc_id"] for r in at.select("doc_id").collect())
    assert got.where("size(ids) <> n_tokens").count() == 0


@pytest.mark.parametrize("case", ["empty", "one null row", "odd columns"])
def test_stages_take_awkward_documents(spark, case):
    from llm_helpers import DOCS, frame

    docs = {
        "empty": lambda: spark.createDataFrame([], DOCS),
        "one null row": lambda: spark.createDataFrame([(None, None, None, None, None)], DOCS),
        "odd columns": lambda: frame(spark).selectExpr("*", "1 AS kept", "'x' AS row", "2 AS print", "3 AS copies", "4 AS rejected"),
    }[case]()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_nothing_else_imports_the_subpackage():
    for path in Path(ROOT, "geoingest").rglob("*.py"):
        if "llm" not in path.parts:
            assert "geoingest.llm" not in path.read_text()
