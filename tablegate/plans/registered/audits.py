"""Reports over the load audit and over query costs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tablegate.functions import batch_id
from tablegate.operators import audit
from tablegate.operators.audit import AUDIT_SCHEMA, audit_append
from tablegate.plans.registered import Query
from tablegate.plans.registered.inputs import table
from tablegate.session import scratch_path


def attempts(spark, folder):
    """An audit with one attempt per (user, day): events are its rows.

    Clicks count as inserted, views as updated, errors as rejected; a unit with
    none of the first two was skipped, and the two halves of the month are runs.
    """
    events = table(spark, folder, "events")
    units = events.groupBy(
        F.col("user_id").cast("string").alias("city_id"), F.to_date("ts").alias("observation_date")
    ).agg(
        F.count(F.lit(1)).alias("rows_fetched"),
        F.count_if(F.col("event_type") == "click").alias("rows_inserted"),
        F.count_if(F.col("event_type") == "view").alias("rows_updated"),
        F.count_if(F.col("event_type") == "error").alias("rows_rejected"),
        F.min("ts").alias("started_at_utc"),
    )
    changed = F.col("rows_inserted") + F.col("rows_updated") > 0
    return units.withColumns(
        {
            "run_id": F.when(F.dayofmonth("observation_date") <= 15, "first").otherwise("second"),
            "dataset": F.lit("events"),
            "contract_version": F.lit(1),
            "batch_id": batch_id("city_id", "observation_date"),
            "status": F.when(changed, "loaded").otherwise("skipped_unchanged"),
        }
    )


def stored_attempts(spark, folder):
    """The audit appended run by run, read back."""
    path = scratch_path(spark, "audit")
    rows = attempts(spark, folder)
    for run in ("first", "second"):
        audit_append(rows.filter(F.col("run_id") == run), path)
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def appended(spark, folder):
    return stored_attempts(spark, folder).select(
        "run_id", "city_id", "observation_date", "batch_id", "rows_fetched", "status", "started_at_utc"
    )


def by_day(spark, folder):
    return audit.audit_by_day(attempts(spark, folder), "second")


def summary(spark, folder):
    return audit.run_summary(attempts(spark, folder), ["run_id"])


def total(spark, folder):
    return audit.run_summary(attempts(spark, folder))


def recent(spark, folder):
    found = audit.recent_attempts(attempts(spark, folder), datetime(2024, 1, 30, 23, 59))
    return found.select("run_id", "city_id", "observation_date", "status", "started_at_utc")


def _metrics(spark, folder):
    """Events as a query history; every second type was started by hand."""
    tag = F.when(F.col("event_type").isin("click", "view"), "Scheduled__").otherwise("manual__")
    cents = F.round(F.col("value") * 100).cast("long")
    return table(spark, folder, "events").select(
        F.concat(tag, "event_type").alias("query_tag"),
        F.col("event_type").alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        cents.alias("execution_time"),
        cents.alias("credits"),
        cents.alias("credits_used"),
    )


def cost_by_tag(spark, folder):
    return audit.cost_by_tag(_metrics(spark, folder), datetime(2024, 1, 20))


def cost_by_day(spark, folder):
    return audit.cost_by_day(_metrics(spark, folder), datetime(2024, 1, 10))


_ATTEMPTS_SQL = """
    WITH units AS (
        SELECT CAST(user_id AS VARCHAR) AS city_id, CAST(ts AS DATE) AS observation_date,
               count(*) AS rows_fetched, count(*) FILTER (WHERE event_type = 'click') AS rows_inserted,
               count(*) FILTER (WHERE event_type = 'view') AS rows_updated,
               count(*) FILTER (WHERE event_type = 'error') AS rows_rejected,
               min(ts) AS started_at_utc
        FROM events GROUP BY ALL),
    audit AS (
        SELECT *, CASE WHEN day(observation_date) <= 15 THEN 'first' ELSE 'second' END AS run_id,
               CASE WHEN rows_inserted + rows_updated > 0 THEN 'loaded'
                    ELSE 'skipped_unchanged' END AS status
        FROM units)
"""
_SUMMARY = """
    count(*) AS partitions_attempted,
    count(*) FILTER (WHERE status = 'loaded') AS partitions_loaded,
    count(*) FILTER (WHERE status NOT IN ('loaded', 'failed')) AS partitions_skipped,
    count(*) FILTER (WHERE status = 'failed') AS partitions_failed,
    CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
    CAST(sum(rows_updated) AS BIGINT) AS rows_updated,
    CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected
"""
_CENTS = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT)"

QUERIES = {
    "audit_append": Query(
        appended,
        _ATTEMPTS_SQL
        + """
        SELECT run_id, city_id, observation_date,
               substr(sha256(city_id || '|' || strftime(observation_date, '%Y-%m-%d') || '|v1'), 1, 32)
                   AS batch_id, rows_fetched, status, started_at_utc
        FROM audit
        """,
    ),
    "audit_by_day": Query(
        by_day,
        _ATTEMPTS_SQL
        + """
        SELECT observation_date, count(*) AS units,
               CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
               CAST(sum(rows_updated) AS BIGINT) AS rows_updated
        FROM audit WHERE run_id = 'second' GROUP BY observation_date
        """,
    ),
    "run_summary": Query(
        summary, _ATTEMPTS_SQL + f"SELECT run_id, {_SUMMARY} FROM audit GROUP BY run_id"
    ),
    "run_total": Query(total, _ATTEMPTS_SQL + f"SELECT {_SUMMARY} FROM audit"),
    "recent_attempts": Query(
        recent,
        _ATTEMPTS_SQL
        + """
        SELECT run_id, city_id, observation_date, status, started_at_utc FROM audit
        WHERE started_at_utc >= TIMESTAMP '2024-01-30 11:59:00' ORDER BY started_at_utc DESC
        """,
    ),
    "cost_by_tag": Query(
        cost_by_tag,
        f"""
        SELECT 'Scheduled__' || event_type AS query_tag, count(*) AS queries,
               CAST({_CENTS} AS DOUBLE) / 1000 AS seconds, {_CENTS} AS credits
        FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND event_type IN ('click', 'view')
        GROUP BY event_type
        """,
    ),
    "cost_by_day": Query(
        cost_by_day,
        f"""
        SELECT event_type AS warehouse_name, date_trunc('day', ts) AS day,
               {_CENTS} AS credits, {_CENTS} * 3 AS usd
        FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL
        """,
    ),
}
