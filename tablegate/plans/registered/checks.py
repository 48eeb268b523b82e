"""Data checks with hits and misses on the driver's tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tablegate.operators import checks
from tablegate.operators.checks import Check, run_checks
from tablegate.plans.marts import agg_weather_daily
from tablegate.plans.registered import Query
from tablegate.plans.registered.contracts import events_by_day
from tablegate.plans.registered.inputs import table
from tablegate.plans.registered.rollups import TYPE_FACT_SQL, USER_FACT_SQL, fact_by_type, fact_by_user
from tablegate.session import scratch_path

TYPES = ["click", "view", "purchase", "signup"]
LINE = ["l_orderkey", "l_linenumber"]
NOW = datetime(2024, 1, 25)


def unique(spark, folder):
    return checks.check_unique(table(spark, folder, "lineitem"), "l_orderkey")


def unique_combination(spark, folder):
    return checks.check_unique_combination(table(spark, folder, "lineitem"), LINE)


def _without_errors(spark, folder):
    """Events whose type is missing where it was 'error'."""
    return table(spark, folder, "events").withColumn(
        "event_type", F.nullif("event_type", F.lit("error"))
    )


def not_null(spark, folder):
    return checks.check_not_null(_without_errors(spark, folder), "event_type").select("event_id")


def relationships(spark, folder):
    solvent = table(spark, folder, "customer").filter(F.col("c_acctbal") >= 0)
    orders = table(spark, folder, "orders")
    return checks.check_relationships(orders, "o_custkey", solvent, "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


def accepted_values(spark, folder):
    return checks.check_accepted_values(table(spark, folder, "events"), "event_type", TYPES)


def accepted_range(spark, folder):
    found = checks.check_accepted_range(table(spark, folder, "customer"), "c_acctbal", 0, 9500)
    return found.select("c_custkey", "c_acctbal")


def freshness(spark, folder):
    now = datetime(2024, 2, 1, 5, 26)
    return checks.check_freshness(table(spark, folder, "events"), "ts", now, ["event_type"])


def _stale_daily(hourly):
    """The daily aggregate, last built at noon of the 20th."""
    before = F.col("observed_at_utc") < F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return agg_weather_daily(hourly.filter(before))


def reconcile(spark, folder):
    hourly = fact_by_user(spark, folder)
    return checks.check_reconcile(hourly, _stale_daily(hourly), ["city_id", "observation_date"])


def completeness(spark, folder):
    found = checks.check_completeness(agg_weather_daily(fact_by_user(spark, folder)))
    return found.select("city_id", "observation_date", "hours_observed", "missing_hours")


def calendar_gaps(spark, folder):
    return checks.check_calendar_gaps(events_by_day(spark, folder), "user_id", "day")


def no_future(spark, folder):
    return checks.check_no_future(table(spark, folder, "events"), "ts", NOW).select("event_id", "ts")


def range_completeness(spark, folder):
    daily = agg_weather_daily(fact_by_type(spark, folder))
    return checks.check_range_completeness(
        daily, date(2024, 1, 5), date(2024, 1, 28), "city_id", 5, 115
    )


def _checks(spark, folder):
    events, customer = table(spark, folder, "events"), table(spark, folder, "customer")
    lines = table(spark, folder, "lineitem")
    return [
        Check("user_missing", events, checks.is_missing("user_id")),
        Check("value_range", events, checks.is_outside("value", 0, 200), severity="warn"),
        Check("future", events, checks.is_future("ts", NOW)),
        Check("balance_range", customer, checks.is_outside("c_acctbal", 0, 9500)),
        Check("line_grain", failing=checks.check_unique_combination(lines, LINE)),
        Check("event_unique", failing=checks.check_unique(events, "event_id")),
        Check("types", failing=checks.check_accepted_values(events, "event_type", TYPES), severity="warn"),
        Check("orders_customer", failing=relationships(spark, folder)),
        Check("days", failing=calendar_gaps(spark, folder), severity="warn"),
    ]


def summary(spark, folder):
    return run_checks(_checks(spark, folder))


def stored_summary(spark, folder):
    return run_checks(_checks(spark, folder), store_to=scratch_path(spark, "failures"))


_GAPS_SQL = """
    SELECT user_id, missing_date FROM (
        SELECT user_id, CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)),
                                                    INTERVAL 1 DAY)) AS DATE) AS missing_date
        FROM events GROUP BY user_id)
    EXCEPT SELECT user_id, CAST(ts AS DATE) FROM events
"""
_ORPHANS_SQL = """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
"""
_TYPES_SQL = """
    SELECT event_type AS value_field, count(*) AS n_records FROM events
    WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup') GROUP BY event_type
"""
_FUTURE_SQL = "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-25 01:00:00'"
_GRAIN_SQL = """
    SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""
_SUMMARY_SQL = f"""
    WITH counts AS (
        SELECT 'user_missing' AS check, 'error' AS severity,
               count(*) FILTER (WHERE user_id IS NULL) AS failures FROM events
        UNION ALL SELECT 'value_range', 'warn',
               count(*) FILTER (WHERE value NOT BETWEEN 0 AND 200) FROM events
        UNION ALL SELECT 'future', 'error', count(*) FROM ({_FUTURE_SQL})
        UNION ALL SELECT 'balance_range', 'error',
               count(*) FILTER (WHERE c_acctbal NOT BETWEEN 0 AND 9500) FROM customer
        UNION ALL SELECT 'line_grain', 'error', count(*) FROM ({_GRAIN_SQL})
        UNION ALL SELECT 'event_unique', 'error', count(*) FROM (
               SELECT event_id FROM events GROUP BY event_id HAVING count(*) > 1)
        UNION ALL SELECT 'types', 'warn', count(*) FROM ({_TYPES_SQL})
        UNION ALL SELECT 'orders_customer', 'error', count(*) FROM ({_ORPHANS_SQL})
        UNION ALL SELECT 'days', 'warn', count(*) FROM ({_GAPS_SQL}))
    SELECT "check", severity, failures,
           CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status
    FROM counts
"""
_DAILY_HOURS_SQL = """,
    daily AS (SELECT city_id, observation_date, count(*) AS hours_observed FROM fact GROUP BY ALL)
"""
_HOURS_SQL, _USER_HOURS_SQL = TYPE_FACT_SQL + _DAILY_HOURS_SQL, USER_FACT_SQL + _DAILY_HOURS_SQL

QUERIES = {
    "check_unique": Query(
        unique,
        """
        SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem
        GROUP BY l_orderkey HAVING count(*) > 1
        """,
    ),
    "check_unique_combination": Query(unique_combination, _GRAIN_SQL),
    "check_not_null": Query(not_null, "SELECT event_id FROM events WHERE event_type = 'error'"),
    "check_relationships": Query(relationships, _ORPHANS_SQL),
    "check_accepted_values": Query(accepted_values, _TYPES_SQL),
    "check_accepted_range": Query(
        accepted_range,
        "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9500",
    ),
    "check_freshness": Query(
        freshness,
        """
        SELECT event_type, max(ts) AS max_loaded_at,
               CASE WHEN max(ts) < TIMESTAMP '2024-02-01 05:26:00' - INTERVAL 48 HOUR THEN 'error'
                    WHEN max(ts) < TIMESTAMP '2024-02-01 05:26:00' - INTERVAL 30 HOUR THEN 'warn'
                    ELSE 'pass' END AS status
        FROM events GROUP BY event_type
        """,
    ),
    "check_reconcile": Query(
        reconcile,
        USER_FACT_SQL
        + """
        SELECT * FROM (
            SELECT city_id, observation_date, count(*) AS fact_rows,
                   nullif(count(*) FILTER (
                       WHERE observed_at_utc < TIMESTAMP '2024-01-20 12:00:00'), 0) AS hours_observed
            FROM fact GROUP BY ALL)
        WHERE fact_rows IS DISTINCT FROM hours_observed
        """,
    ),
    "check_completeness": Query(
        completeness,
        _USER_HOURS_SQL
        + """
        SELECT city_id, observation_date, hours_observed, 24 - hours_observed AS missing_hours
        FROM daily
        WHERE hours_observed <> 24
          AND observation_date < (SELECT max(observation_date) - 1 FROM daily)
        """,
    ),
    "check_calendar_gaps": Query(calendar_gaps, _GAPS_SQL),
    "check_no_future": Query(no_future, _FUTURE_SQL),
    "range_completeness": Query(
        range_completeness,
        _HOURS_SQL
        + """
        SELECT observation_date, count(DISTINCT city_id) AS entities,
               CAST(sum(hours_observed) AS BIGINT) AS hours
        FROM daily WHERE observation_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-28'
        GROUP BY observation_date HAVING count(DISTINCT city_id) < 5 OR sum(hours_observed) < 115
        """,
    ),
    "checks_summary": Query(summary, _SUMMARY_SQL),
    "checks_stored": Query(stored_summary, _SUMMARY_SQL),
}
