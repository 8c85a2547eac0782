"""Every registered query: same rows, columns and types as its check SQL, and a sound plan."""

import ast
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.workload.checks import CHECKS
from tidemark.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


def test_no_name_is_defined_twice():
    """A second definition replaces the first without a word."""
    for path in Path(entry.__file__).parent.joinpath("tidemark").rglob("*.py"):
        names = [n.name for n in ast.parse(path.read_text()).body if isinstance(n, ast.FunctionDef | ast.ClassDef)]
        assert len(names) == len(set(names)), path


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_check(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    result = duck.execute(CHECKS[name])
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_entry_runs(spark):
    assert len(entry.entry(spark).columns) == 6


@pytest.mark.parametrize("name", ["claim_performance", "inventory_status", "kpi_policy", "risk_score", "knn_topk", "rag_history"])
def test_no_cross_joins(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = entry.queries()["dedup_count"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    plan = entry.queries()["customer_identity"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "c_name" not in plan.split("ReadSchema", 1)[1]
