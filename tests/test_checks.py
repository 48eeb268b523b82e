from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablegate.operators.checks import (
    Check,
    check_accepted_range,
    check_accepted_values,
    check_calendar_gaps,
    check_completeness,
    check_freshness,
    check_no_future,
    check_not_null,
    check_range_completeness,
    check_reconcile,
    check_relationships,
    check_unique,
    check_unique_combination,
    is_missing,
    is_outside,
    run_checks,
)

DAY = date(2025, 3, 20)


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 5.0), (2, "a", None), (None, "x", 10.1), (None, None, float("nan"))],
        "k int, t string, v double",
    )


def test_column_checks(rows):
    assert tuples(check_unique(rows, "k")) == [(1, 2)]
    assert check_not_null(rows, "k").count() == 2
    assert tuples(check_accepted_values(rows, "t", ["a", "b"])) == [("x", 1)]
    assert check_accepted_range(rows, "v", 1, 10).count() == 2
    assert check_accepted_range(rows, "v", 1, 10, inclusive=False).count() == 3
    assert check_accepted_range(rows, "v", low=0).count() == 0
    with pytest.raises(ValueError, match="bound"):
        is_outside("v")


def test_combination_counts_nulls(rows):
    assert tuples(check_unique_combination(rows, ["k", "t"])) == []
    assert (None, 2) in [tuple(r) for r in check_unique_combination(rows, ["k"]).collect()]


def test_relationships(spark, rows):
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert [r.k for r in check_relationships(rows, "k", parent, "id").collect()] == [2]


def test_freshness(spark):
    now = datetime(2025, 3, 20, 12)
    ages = {"a": 30, "b": 31, "c": 48, "d": 49}
    df = spark.createDataFrame(
        [(k, now - timedelta(hours=h)) for k, h in ages.items()] + [("e", None)],
        "k string, t timestamp_ntz",
    )
    found = {r.k: r.status for r in check_freshness(df, "t", now, ["k"]).collect()}
    assert found == {"a": "pass", "b": "warn", "c": "warn", "d": "error", "e": "error"}
    assert check_freshness(df, "t", now).first().status == "pass"
    assert check_freshness(df.limit(0), "t", now).first().status == "error"


def test_reconcile(spark):
    fact = spark.createDataFrame([("a", DAY)] * 3 + [("b", DAY)] * 2 + [("c", DAY)], "k string, d date")
    daily = spark.createDataFrame(
        [("a", DAY, 3), ("b", DAY, 1), ("d", DAY, 4), ("e", DAY, None)], "k string, d date, hours_observed long"
    )
    found = {r.k: (r.fact_rows, r.hours_observed) for r in check_reconcile(fact, daily, ["k", "d"]).collect()}
    assert found == {"b": (2, 1), "c": (1, None), "d": (None, 4)}


def test_completeness_skips_filling_days(spark):
    daily = spark.createDataFrame(
        [("a", DAY - timedelta(days=n), 20) for n in range(4)] + [("b", DAY - timedelta(days=3), 24)],
        "city_id string, observation_date date, hours_observed long",
    )
    found = [(r.observation_date, r.missing_hours) for r in check_completeness(daily).collect()]
    assert sorted(found) == [(DAY - timedelta(days=3), 4), (DAY - timedelta(days=2), 4)]


def test_calendar_gaps(spark):
    days = [0, 0, 1, 4, 5]
    df = spark.createDataFrame(
        [("a", DAY + timedelta(days=n)) for n in days] + [("b", DAY), (None, DAY), ("a", None)],
        "city_id string, observation_date date",
    )
    found = [tuple(r) for r in check_calendar_gaps(df, "city_id").collect()]
    assert sorted(found) == [("a", DAY + timedelta(days=2)), ("a", DAY + timedelta(days=3))]
    far = spark.createDataFrame([("a", date(2000, 1, 1)), ("a", date(2020, 1, 1))], df.schema)
    assert check_calendar_gaps(far, "city_id").count() == 7304  # no cap at ten years


def test_no_future(spark):
    now = datetime(2025, 3, 20, 12)
    df = spark.createDataFrame(
        [(now + timedelta(minutes=m),) for m in (0, 60, 61)], "t timestamp_ntz"
    )
    assert check_no_future(df, "t", now).count() == 1


def test_range_completeness(spark):
    daily = spark.createDataFrame(
        [(c, DAY + timedelta(days=n), h) for n, c, h in [(0, "a", 24), (0, "b", 24), (1, "a", 48), (2, "a", 24), (2, "b", 23), (9, "a", 1)]],
        "city_id string, observation_date date, hours_observed long",
    )
    found = check_range_completeness(daily, DAY, DAY + timedelta(days=3), "city_id", 2, 48)
    assert [(r.entities, r.hours) for r in found.orderBy("observation_date").collect()] == [(1, 48), (2, 47)]


def test_run_checks(spark, rows, tmp_path):
    checks = [
        Check("k_missing", rows, is_missing("k")),
        Check("v_range", rows, is_outside("v", 1, 10), severity="warn"),
        Check("t_never", rows, F.col("t") == "never"),
        Check("k_unique", failing=check_unique(rows, "k")),
    ]
    expected = [
        ("k_missing", "error", 2, "error"),
        ("k_unique", "error", 1, "error"),
        ("t_never", "error", 0, "pass"),
        ("v_range", "warn", 2, "warn"),
    ]
    assert tuples(run_checks(checks)) == expected
    assert tuples(run_checks(checks, store_to=str(tmp_path))) == expected
    assert spark.read.parquet(f"{tmp_path}/k_unique").first().n_records == 2


def test_row_checks_share_one_scan(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    checks = [Check(c, table, is_missing(c)) for c in ("k", "t", "v")]
    plan = run_checks(checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_bad_check():
    with pytest.raises(ValueError, match="give a table"):
        Check("x")
    with pytest.raises(ValueError, match="no checks"):
        run_checks([])
