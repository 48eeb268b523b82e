from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablegate.operators.audit import (
    AUDIT_SCHEMA,
    audit_append,
    audit_by_day,
    cost_by_day,
    cost_by_tag,
    loaded_before,
    recent_attempts,
    run_summary,
    skip_unchanged,
)
from tablegate.operators.incremental import (
    clamp_range,
    clamp_window,
    date_range,
    restatement_cutoff,
    restatement_filter,
    target_day,
    union_versions,
    work_units,
)

D = date(2025, 3, 20)


def test_date_range(spark):
    assert [r.day for r in date_range(spark, D, date(2025, 3, 22)).collect()] == [
        D, date(2025, 3, 21), date(2025, 3, 22),
    ]
    assert date_range(spark, D, date(2025, 3, 19)).count() == 0


def test_work_units(catalogue):
    plan = work_units(catalogue, D, date(2025, 3, 22))
    assert plan.count() == 9 and plan.distinct().count() == 9
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
    with pytest.raises(ValueError, match="inverted range"):
        work_units(catalogue, D, date(2025, 3, 19))
    with pytest.raises(ValueError, match="longer than max_days=400"):
        work_units(catalogue, date(2025, 1, 1), date(2026, 2, 5), max_days=400)
    assert work_units(catalogue, date(2025, 1, 1), date(2026, 2, 4), max_days=400).count() == 1200
    assert work_units(catalogue, date(2024, 1, 1), date(2025, 12, 31)).count() == 2193


def test_clamping(spark):
    assert clamp_range(date(2025, 3, 1), D, D, 2) == (date(2025, 3, 1), date(2025, 3, 18))
    assert clamp_range(D, D, D, 2) is None
    assert target_day(datetime(2025, 3, 20, 4), 2) == date(2025, 3, 18)
    assert clamp_window(date_range(spark, date(2025, 3, 15), D), "day", D, 2).count() == 4


def test_restatement(spark):
    rows = date_range(spark, date(2025, 3, 1), date(2025, 3, 31))
    target = rows.filter(F.col("day") <= F.lit(D))
    kept = restatement_filter(rows, "day", target)
    assert kept.agg(F.min("day")).first()[0] == date(2025, 3, 13)
    assert kept.count() == 19
    assert restatement_filter(rows, "day", target.limit(0)).count() == 31
    assert restatement_cutoff(target, "day") == date(2025, 3, 13)
    assert restatement_cutoff(None, "day") < date(1900, 1, 1)


def test_restatement_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    date_range(spark, date(2025, 3, 1), date(2025, 3, 31)).withColumn("v", F.lit(1)).write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    kept = restatement_filter(table, "day", table.filter(F.col("day") <= F.lit(D)))
    assert kept.count() == 19
    scans = [s for s in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in s]
    assert any("PartitionFilters: [isnotnull(day" in s and "date_sub" in s for s in scans)


def test_union_versions(spark):
    v1 = spark.createDataFrame([("a", 10.0)], "id string, celsius double")
    v2 = spark.createDataFrame([("b", 68.0, 1)], "id string, fahrenheit double, extra int")
    both = union_versions([
        (v1, {"id": F.col("id"), "celsius": F.col("celsius"), "version": F.lit(1)}),
        (v2, {"id": F.col("id"), "celsius": (F.col("fahrenheit") - 32) / 1.8, "version": F.lit(2)}),
    ])
    assert sorted(tuple(r) for r in both.collect()) == [("a", 10.0, 1), ("b", 20.0, 2)]


def attempts(spark, *rows):
    full = [
        {
            "run_id": "r1", "dataset": "d", "contract_version": 1, "city_id": "oslo",
            "observation_date": D, "batch_id": "b", "source_payload_hash": "h",
            "rows_inserted": 24, "rows_updated": 0, "rows_rejected": 0, "status": "loaded",
            "error_message": None, "started_at_utc": datetime(2025, 3, 22, 6),
        } | row
        for row in rows
    ]
    fields = [f for f in AUDIT_SCHEMA if f.name in full[0]]
    from pyspark.sql.types import StructType

    return spark.createDataFrame([tuple(r[f.name] for f in fields) for r in full], StructType(fields))


def test_skip_looks_at_unit_hash_and_status(spark):
    audit = attempts(
        spark,
        {"source_payload_hash": "h1"},
        {"source_payload_hash": "h1"},
        {"source_payload_hash": "h2", "status": "failed"},
        {"source_payload_hash": None},
    )
    units = spark.createDataFrame(
        [("oslo", D, "h1"), ("oslo", D, "h2"), ("oslo", D, None), ("lima", D, "h1")],
        "city_id string, observation_date date, source_payload_hash string",
    )
    left = {tuple(r)[0::2] for r in skip_unchanged(units, audit).collect()}
    assert left == {("oslo", "h2"), ("oslo", None), ("lima", "h1")}
    marked = loaded_before(units, audit).collect()
    assert len(marked) == 4 and sum(r.already_loaded for r in marked) == 1


def test_audit_append_and_reports(spark, tmp_path):
    path = str(tmp_path / "audit")
    audit_append(attempts(spark, {}, {"city_id": "lima", "rows_updated": 3}), path)
    audit_append(
        attempts(spark, {"run_id": "r2", "status": "failed", "rows_inserted": 0, "error_message": "x" * 3000, "started_at_utc": datetime(2025, 3, 22, 20)}),
        path,
    )
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(path)
    assert audit.count() == 3
    assert audit.agg(F.max(F.length("error_message"))).first()[0] == 3000
    assert [tuple(r) for r in audit_by_day(audit, "r1").collect()] == [(D, 2, 48, 3)]
    assert [r.run_id for r in recent_attempts(audit, datetime(2025, 3, 22, 21)).collect()] == ["r2"]
    summary = run_summary(audit).first()
    assert (summary.partitions_attempted, summary.partitions_loaded, summary.partitions_skipped) == (3, 2, 0)
    assert summary.partitions_failed == 1
    assert (summary.rows_inserted, summary.rows_updated, summary.rows_rejected) == (48, 3, 0)
    assert run_summary(audit, ["run_id"]).count() == 2
    assert tuple(run_summary(audit.limit(0)).first()) == (0, 0, 0, 0, 0, 0, 0)


def test_costs(spark):
    queries = spark.createDataFrame(
        [("Scheduled__a", datetime(2025, 3, 20), 1500, 0.5), ("scheduled__a", datetime(2025, 3, 20), 500, 0.5), ("manual__a", datetime(2025, 3, 20), 9, 1.0), ("scheduled__a", datetime(2025, 3, 1), 9, 1.0)],
        "query_tag string, start_time timestamp_ntz, execution_time long, credits double",
    )
    rows = [tuple(r) for r in cost_by_tag(queries, datetime(2025, 3, 13)).collect()]
    assert rows == [("Scheduled__a", 1, 1.5, 0.5), ("scheduled__a", 1, 0.5, 0.5)]
    metering = spark.createDataFrame(
        [("w", datetime(2025, 3, 20, 3), 0.5), ("w", datetime(2025, 3, 20, 9), 1.0), ("w", datetime(2025, 3, 21), 2.0)],
        "warehouse_name string, start_time timestamp_ntz, credits_used double",
    )
    rows = [tuple(r) for r in cost_by_day(metering, datetime(2025, 3, 1)).collect()]
    assert rows == [("w", datetime(2025, 3, 21), 2.0, 6.0), ("w", datetime(2025, 3, 20), 1.5, 4.5)]
