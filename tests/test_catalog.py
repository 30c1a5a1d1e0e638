"""Every registered query against its SQL twin, and the shape of its plan."""

from __future__ import annotations

import math
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import ROOT, TESTDATA
from geoingest.plans.catalog import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in TESTDATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def canonical(columns: list[str], data) -> list[tuple]:
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, bool):
            return str(v)
        return repr(float(v)) if isinstance(v, (int, float)) else str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(TESTDATA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert name in SQL
    expected = duck.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    got = df.collect()
    assert canonical(df.columns, got) == canonical(columns, expected.fetchall())
    assert got, "the query must have rows to compare"


def test_entry_offers_all_queries():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_all_modules_import_without_a_session():
    code = "import __spark_entry__, geoingest; assert __spark_entry__.queries()"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    assert entry(spark).count() > 0


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["status_counts"](spark, str(TESTDATA))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan
    plan = QUERIES["failure_upsert"](spark, str(TESTDATA))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan


@pytest.mark.parametrize("name", ["url_dispatch", "coord_pairs", "html_text_stats", "upsert_merge", "gpx_track_points"])
def test_no_python_worker_in_text_and_merge_queries(spark, name):
    plan = QUERIES[name](spark, str(TESTDATA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_elements_of_responses_are_parsed_once(spark):
    plan = QUERIES["osm_response_elements"](spark, str(TESTDATA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson(") + plan.lower().count("parse_json(") == 1 and "to_json" not in plan.lower()
