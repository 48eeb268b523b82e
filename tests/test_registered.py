"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import datetime
import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tablegate.plans.registered import registry

FOLDER = os.environ.get("TABLEGATE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query.run for name, query in registry().items()}
SQL = {name: sql for name, sql in driver.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        files = f"{path}/*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def kind(text):
    text = text.lower()
    for name in ("timestamp", "decimal", "varchar", "string", "bigint", "int", "double", "boolean", "date"):
        if text.startswith(name):
            return {"string": "varchar", "integer": "int"}.get(name, name)
    return text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, FOLDER)
    physical = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in physical
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in row) for row in df.select(columns).collect())
    if name not in SQL:
        assert got
        return
    relation = oracle.sql(SQL[name])
    assert columns == sorted(relation.columns)
    expected_kinds = {c: kind(str(t)) for c, t in zip(relation.columns, relation.types)}
    assert {c: kind(t) for c, t in df.dtypes} == expected_kinds
    order = [relation.columns.index(c) for c in columns]
    rows = oracle.execute(SQL[name]).fetchall()
    expected = Counter(tuple(plain(row[i]) for i in order) for row in rows)
    assert got - expected == Counter() and expected - got == Counter()
    if os.environ.get("TABLEGATE_REQUIRE_ROWS"):
        assert got, "no rows: nothing was compared"


def test_entry(spark):
    assert driver.entry(spark).count() > 0
