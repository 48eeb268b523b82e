"""Row checks and the gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablegate.operators.validate import (
    empty_units,
    flagged,
    gate,
    gate_report,
    split_valid,
    unknown_fields,
    validate,
)
from tablegate.plans.registered import Query
from tablegate.plans.registered.inputs import table
from tablegate.sources.contract import Contract, FieldSpec

CUSTOMER = Contract(
    "customer",
    1,
    (
        FieldSpec("c_custkey", "integer", required=True, min=1),
        FieldSpec("c_name", "string", required=True),
        FieldSpec("c_acctbal", "float", required=True, min=0, max=9500),
    ),
)
EVENT = Contract("event", 1, (FieldSpec("value", "float", required=True, max=200),))
PROPS = Contract("props", 1, (FieldSpec("k", "integer", required=True, min=0, max=90),))
BARE = Contract("bare", 1, (FieldSpec("source", "string"),))
UNIT = ["event_type", "day"]


def events_by_day(spark, folder):
    return table(spark, folder, "events").withColumn("day", F.to_date("ts"))


def validate_reasons(spark, folder):
    checked = validate(table(spark, folder, "customer"), CUSTOMER)
    return checked.filter(F.size("_reasons") > 0).select(
        "c_custkey", F.array_join("_reasons", ";").alias("reasons")
    )


def split_accepted(spark, folder):
    return split_valid(table(spark, folder, "customer"), CUSTOMER)[0].select("c_custkey", "c_acctbal")


def split_rejected(spark, folder):
    rejected = split_valid(table(spark, folder, "customer"), CUSTOMER)[1]
    return rejected.select("c_custkey", F.size("_reasons").cast("long").alias("n_reasons"))


def report(spark, folder):
    events = flagged(events_by_day(spark, folder), EVENT)
    return gate_report(events, UNIT, F.col("_rejected"))


def gate_accepted(spark, folder):
    return gate(events_by_day(spark, folder), EVENT, UNIT).accepted.select("event_id", *UNIT, "value")


def gate_rejected(spark, folder):
    rejected = gate(events_by_day(spark, folder), EVENT, UNIT).rejected
    return rejected.select("event_id", F.element_at("_reasons", 1).alias("reason"))


def _parsed_props(spark, folder):
    return table(spark, folder, "events").withColumn("document", F.try_parse_json("props"))


def unknown(spark, folder):
    return unknown_fields(_parsed_props(spark, folder), BARE, "document", ["event_type"])


def typed_json_violations(spark, folder):
    rejected = split_valid(_parsed_props(spark, folder), PROPS, document="document")[1]
    return rejected.select("event_id", F.array_join("_reasons", ";").alias("reasons"))


def empty(spark, folder):
    events = events_by_day(spark, folder)
    days = events.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    span = F.sequence(
        days.select("first").scalar(), days.select("last").scalar(), F.expr("interval 1 day")
    )
    plan = events.select("user_id").distinct().select("user_id", F.explode(span).alias("day"))
    return empty_units(plan, events, ["user_id", "day"])


_VALID = "c_custkey >= 1 AND c_acctbal BETWEEN 0 AND 9500"
_REPORT_SQL = """
    SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS total_rows,
           count(*) FILTER (WHERE value <= 200) AS accepted_rows,
           count(*) FILTER (WHERE value > 200) AS rejected_rows,
           CAST(count(*) FILTER (WHERE value > 200) AS DOUBLE) / count(*) AS reject_ratio,
           CAST(count(*) FILTER (WHERE value > 200) AS DOUBLE) / count(*) <= 0.02 AS passed
    FROM events GROUP BY ALL
"""

QUERIES = {
    "validate_reasons": Query(
        validate_reasons,
        f"""
        SELECT c_custkey, concat_ws(';',
                   CASE WHEN c_custkey < 1
                        THEN 'c_custkey: ' || c_custkey || ' below contract minimum 1' END,
                   CASE WHEN c_acctbal < 0
                        THEN 'c_acctbal: ' || CAST(c_acctbal AS VARCHAR) || ' below contract minimum 0'
                   END,
                   CASE WHEN c_acctbal > 9500
                        THEN 'c_acctbal: ' || CAST(c_acctbal AS VARCHAR)
                             || ' above contract maximum 9500' END) AS reasons
        FROM customer WHERE NOT ({_VALID})
        """,
    ),
    "split_accepted": Query(
        split_accepted, f"SELECT c_custkey, c_acctbal FROM customer WHERE {_VALID}"
    ),
    "split_rejected": Query(
        split_rejected,
        f"""
        SELECT c_custkey, CAST(c_custkey < 1 AS BIGINT) + CAST(c_acctbal NOT BETWEEN 0 AND 9500 AS BIGINT)
                   AS n_reasons
        FROM customer WHERE NOT ({_VALID})
        """,
    ),
    "gate_report": Query(report, _REPORT_SQL),
    "gate_accepted": Query(
        gate_accepted,
        f"""
        WITH report AS ({_REPORT_SQL})
        SELECT e.event_id, e.event_type, r.day, e.value
        FROM events e JOIN report r ON e.event_type = r.event_type AND CAST(e.ts AS DATE) = r.day
        WHERE r.passed AND e.value <= 200
        """,
    ),
    "gate_rejected": Query(
        gate_rejected,
        """
        SELECT event_id,
               'value: ' || CAST(value AS VARCHAR) || ' above contract maximum 200' AS reason
        FROM events WHERE value > 200
        """,
    ),
    "unknown_fields": Query(
        unknown,
        """
        SELECT event_type, field, count(*) AS n_rows
        FROM (SELECT event_type, unnest(json_keys(props)) AS field FROM events)
        WHERE field <> 'source' GROUP BY ALL
        """,
    ),
    "typed_json_violations": Query(
        typed_json_violations,
        """
        SELECT event_id,
               'k: ' || CAST(json_extract(props, '$.k') AS VARCHAR) || ' above contract maximum 90'
                   AS reasons
        FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 90
        """,
    ),
    "empty_units": Query(
        empty,
        """
        WITH span AS (SELECT min(CAST(ts AS DATE)) AS low, max(CAST(ts AS DATE)) AS high FROM events),
        days AS (SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day
                 FROM span),
        plan AS (SELECT user_id, day FROM (SELECT DISTINCT user_id FROM events), days)
        SELECT user_id, day FROM plan
        EXCEPT SELECT user_id, CAST(ts AS DATE) FROM events
        """,
    ),
}
