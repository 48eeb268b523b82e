"""The corpus queries that have SQL, against it, on the smallest tables."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as driver
from tests.test_registered import FOLDER, kind, oracle, plain  # noqa: F401

SQL = {name: sql for name, sql in driver.oracle_sql().items() if name in driver.corpus_queries.SQL}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, oracle, name):  # noqa: F811
    df = driver.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    relation = oracle.sql(SQL[name])
    assert columns == sorted(relation.columns)
    kinds = {c: kind(str(t)) for c, t in zip(relation.columns, relation.types)}
    assert {c: kind(t) for c, t in df.dtypes} == kinds
    got = Counter(tuple(plain(v) for v in row) for row in df.select(columns).collect())
    order = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(plain(row[i]) for i in order) for row in oracle.execute(SQL[name]).fetchall())
    assert got and got == expected
