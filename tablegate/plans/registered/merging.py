"""Deduplication, upsert and incremental windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tablegate.functions import payload_hash
from tablegate.operators.audit import loaded_before, skip_unchanged
from tablegate.operators.dedupe import dedupe_latest
from tablegate.operators.incremental import (
    clamp_window,
    restatement_filter,
    stored_cutoff,
    work_units,
)
from tablegate.operators.merge import incremental_merge, merge_counts, merge_rows, upsert
from tablegate.plans.registered import Query
from tablegate.plans.registered.contracts import events_by_day
from tablegate.plans.registered.inputs import BY_USER, by_user, table, weather_payloads
from tablegate.session import scratch_path
from tablegate.sources.publish import read_table, replace_partitions, schema_history

KEYS = ["o_orderkey"]
ROW = ["o_orderkey", "o_orderstatus", "price", "month", "hash"]


def _versioned(orders):
    """Orders with a hash of their content and the month they are stored under."""
    content = F.concat_ws("|", "o_orderstatus", F.round(F.col("price") * 100).cast("long").cast("string"))
    return orders.select(
        "o_orderkey",
        "o_orderstatus",
        "price",
        F.trunc("o_orderdate", "month").alias("month"),
        F.sha2(content, 256).alias("hash"),
    )


def _target(spark, folder):
    """Orders before 1999."""
    orders = table(spark, folder, "orders").withColumn("price", F.col("o_totalprice"))
    return _versioned(orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))


def _source(spark, folder):
    """Orders from 1998 on; the price of urgent ones was restated."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    price = F.when(urgent, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice"))
    orders = table(spark, folder, "orders").withColumn("price", price)
    return _versioned(orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))


def latest_lines(spark, folder):
    return dedupe_latest(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


def upsert_result(spark, folder):
    merged = merge_rows(_target(spark, folder), _source(spark, folder), KEYS, "hash")
    return merged.select("o_orderkey", "o_orderstatus", "price", "month", F.col("_action").alias("action"))


def upsert_actions(spark, folder):
    return merge_counts(merge_rows(_target(spark, folder), _source(spark, folder), KEYS, "hash"))


def _stored(spark, folder):
    """The target written, then the source merged into it twice."""
    path = scratch_path(spark, "orders")
    batches = [_target(spark, folder), _source(spark, folder), _source(spark, folder)]
    return path, [upsert(spark, path, batch, KEYS, "month", "hash") for batch in batches]


def upsert_rerun(spark, folder):
    _, attempts = _stored(spark, folder)
    parts = [
        counts.agg(
            F.lit(number).alias("attempt"),
            F.sum("rows_inserted").alias("rows_inserted"),
            F.sum("rows_updated").alias("rows_updated"),
        )
        for number, counts in enumerate(attempts, 1)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def upsert_table(spark, folder):
    path, _ = _stored(spark, folder)
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "price", "month")


def upsert_observed(spark, folder):
    """Two merges of a mart, counted by the jobs that write them."""
    path = scratch_path(spark, "orders")
    batches = [_target(spark, folder), _source(spark, folder)]
    rows = []
    for number, batch in enumerate(batches, 1):
        counts = incremental_merge(spark, path, batch, KEYS, "month")
        rows.append((number, *(counts[f"rows_{name}"] for name in ("inserted", "updated", "kept"))))
    names = "attempt int, rows_inserted long, rows_updated long, rows_kept long"
    return spark.createDataFrame(rows, names)


def schema_evolution(spark, folder):
    """A mart whose second run adds a column, read by its schema file."""
    path = scratch_path(spark, "orders")
    incremental_merge(spark, path, _target(spark, folder), KEYS, "month")
    source = _source(spark, folder).withColumn("cents", F.round(F.col("price") * 100).cast("long"))
    incremental_merge(spark, path, source, KEYS, "month")
    versions = len(schema_history(spark, path))
    return read_table(spark, path).select("o_orderkey", "price", "month", "cents", F.lit(versions).alias("versions"))


def stored_window(spark, folder):
    """The restatement window of a stored mart: its newest day is a folder name."""
    path = scratch_path(spark, "days")
    events = events_by_day(spark, folder).select("event_id", "day", "value")
    replace_partitions(events.filter(F.col("day") <= F.lit(date(2024, 1, 20))), path, ["day"])
    return events.filter(F.col("day") >= F.lit(stored_cutoff(spark, path, "day")))


def restatement_window(spark, folder):
    events = events_by_day(spark, folder).select("event_id", "day", "value")
    loaded = events.filter(F.col("day") <= F.lit(date(2024, 1, 20)))
    return restatement_filter(events, "day", loaded)


def clamped_units(spark, folder):
    units = events_by_day(spark, folder).select("event_type", "day").distinct()
    return clamp_window(units, "day", date(2024, 1, 20), 2)


def planned_units(spark, folder):
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("city_id"))
    return work_units(users, date(2024, 1, 1), date(2024, 1, 30))


def _payload_units(spark, folder):
    """Units with the hash of their payload now, and as loaded up to noon of the 15th."""
    events = by_user(table(spark, folder, "events"))
    unit = ["city_id", "observation_date"]

    def hashed(rows):
        return weather_payloads(rows).select(*unit, payload_hash("payload").alias("source_payload_hash"))

    earlier = events.filter(F.col("ts") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    audit = hashed(earlier).withColumn("status", F.lit("loaded"))
    return hashed(events), audit


def unchanged_skipped(spark, folder):
    return skip_unchanged(*_payload_units(spark, folder)).select("city_id", "observation_date")


def load_state(spark, folder):
    return loaded_before(*_payload_units(spark, folder)).select(
        "city_id", "observation_date", "already_loaded"
    )


_HASH = "o_orderstatus || '|' || CAST(CAST(round(price * 100) AS BIGINT) AS VARCHAR)"
_MERGED_SQL = f"""
    WITH target AS (
        SELECT o_orderkey, o_orderstatus, o_totalprice AS price,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month
        FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    source AS (
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100 ELSE o_totalprice END
                   AS price,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
    t AS (SELECT *, {_HASH} AS hash FROM target),
    s AS (SELECT *, {_HASH} AS hash FROM source),
    merged AS (
        SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
               CASE WHEN t.hash = s.hash OR s.hash IS NULL THEN t.o_orderstatus
                    ELSE s.o_orderstatus END AS o_orderstatus,
               CASE WHEN t.hash = s.hash OR s.hash IS NULL THEN t.price ELSE s.price END AS price,
               coalesce(t.month, s.month) AS month,
               CASE WHEN t.hash IS NULL THEN 'insert' WHEN s.hash IS NULL THEN 'keep'
                    WHEN t.hash = s.hash THEN 'unchanged' ELSE 'update' END AS action
        FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey)
"""
_STATE_SQL = f"""
    WITH units AS (
        SELECT event_type AS city_id, CAST(ts AS DATE) AS observation_date,
               max(ts) < TIMESTAMP '2024-01-15 12:00:00' AS already_loaded
        FROM {BY_USER} GROUP BY ALL)
"""

QUERIES = {
    "dedupe_latest": Query(
        latest_lines,
        """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) = 1
        """,
    ),
    "upsert_result": Query(upsert_result, _MERGED_SQL + "SELECT * FROM merged"),
    "upsert_actions": Query(
        upsert_actions,
        _MERGED_SQL
        + """
        SELECT count(*) FILTER (WHERE action = 'insert') AS rows_inserted,
               count(*) FILTER (WHERE action = 'update') AS rows_updated,
               count(*) FILTER (WHERE action = 'unchanged') AS rows_unchanged,
               count(*) FILTER (WHERE action = 'keep') AS rows_kept
        FROM merged
        """,
    ),
    "upsert_rerun": Query(
        upsert_rerun,
        _MERGED_SQL
        + """
        SELECT 1 AS attempt, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated FROM t
        UNION ALL
        SELECT 2, count(*) FILTER (WHERE action = 'insert'),
               count(*) FILTER (WHERE action = 'update') FROM merged
        UNION ALL SELECT 3, 0, 0
        """,
    ),
    "upsert_table": Query(
        upsert_table, _MERGED_SQL + "SELECT o_orderkey, o_orderstatus, price, month FROM merged"
    ),
    "upsert_observed": Query(
        upsert_observed,
        _MERGED_SQL
        + """
        SELECT 1 AS attempt, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
               CAST(0 AS BIGINT) AS rows_kept FROM t
        UNION ALL
        SELECT 2, count(*) FILTER (WHERE action = 'insert'),
               count(*) FILTER (WHERE action IN ('update', 'unchanged')),
               count(*) FILTER (WHERE action = 'keep' AND month IN (SELECT month FROM s)) FROM merged
        """,
    ),
    "schema_evolution": Query(
        schema_evolution,
        _MERGED_SQL
        + """
        SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.price, t.price) AS price,
               coalesce(t.month, s.month) AS month, CAST(round(s.price * 100) AS BIGINT) AS cents, 2 AS versions
        FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
        """,
    ),
    "stored_window": Query(
        stored_window,
        """
        SELECT event_id, CAST(ts AS DATE) AS day, value FROM events
        WHERE CAST(ts AS DATE) >= (
            SELECT max(CAST(ts AS DATE)) - 7 FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20')
        """,
    ),
    "restatement_window": Query(
        restatement_window,
        """
        SELECT event_id, CAST(ts AS DATE) AS day, value FROM events
        WHERE CAST(ts AS DATE) >= (
            SELECT max(CAST(ts AS DATE)) - 7 FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20')
        """,
    ),
    "clamp_window": Query(
        clamped_units,
        """
        SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events
        WHERE CAST(ts AS DATE) <= DATE '2024-01-18'
        """,
    ),
    "work_units": Query(
        planned_units,
        """
        SELECT c_custkey AS city_id, CAST(day AS DATE) AS observation_date
        FROM customer, generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) d(day)
        """,
    ),
    "skip_unchanged": Query(
        unchanged_skipped,
        _STATE_SQL + "SELECT city_id, observation_date FROM units WHERE NOT already_loaded",
    ),
    "already_loaded": Query(load_state, _STATE_SQL + "SELECT * FROM units"),
}
