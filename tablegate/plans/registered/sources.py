"""Payloads, responses, catalogue, identity, landing and quarantine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions import batch_id, payload_hash, row_hash, surrogate_key
from tablegate.operators.incremental import union_versions
from tablegate.operators.validate import split_valid
from tablegate.plans.registered import Query
from tablegate.plans.registered.contracts import EVENT, UNIT, events_by_day
from tablegate.plans.registered.inputs import (
    BY_USER,
    READINGS_SQL,
    by_user,
    customers_as_cities,
    prop_k,
    readings,
    table,
    weather_payloads,
)
from tablegate.session import scratch_path
from tablegate.sources.catalogue import Bound, out_of_bounds, read_catalogue
from tablegate.sources.landing import land, land_units, landed_hashes, read_landed
from tablegate.sources.payloads import (
    classify_responses,
    flatten_series,
    read_payloads,
    refused_units,
    unknown_series,
    with_series,
)
from tablegate.sources.quarantine import quarantine_lines, read_quarantine, write_quarantine

SERIES = {"value": "wind_speed_10m", "k": "weather_code"}
UNIT_SCHEMA = T.StructType(
    [T.StructField("observation_date", T.DateType()), T.StructField("city_id", T.StringType())]
)


def _typed(parsed):
    flat = flatten_series(parsed, SERIES, ["city_id"])
    return flat.select(
        "city_id",
        F.try_variant_get("observed_at_utc", "$", "string").alias("observed_at"),
        F.try_variant_get("value", "$", "double").alias("value"),
        F.try_variant_get("k", "$", "int").alias("k"),
    )


def flatten(spark, folder):
    return _typed(with_series(weather_payloads(by_user(table(spark, folder, "events"))), SERIES, "city_id"))


def payload_files(spark, folder):
    """Payloads written as one file per unit, read back and flattened."""
    path = scratch_path(spark, "payload-files")
    payloads = weather_payloads(table(spark, folder, "events"))
    payloads.write.partitionBy("observation_date", "city_id").text(path)
    return _typed(with_series(read_payloads(spark, path, UNIT_SCHEMA), SERIES, "city_id"))


def ragged(spark, folder):
    """All 24 hours in ``time``, but values only for hours with a reading."""
    rows = readings(by_user(table(spark, folder, "events")))
    units = rows.groupBy("event_type", "day").agg(
        F.sort_array(F.collect_list(F.struct("hour", "value"))).alias("h")  # at most 24
    )
    hours = F.sequence(
        F.col("day").cast("timestamp_ntz"),
        F.col("day").cast("timestamp_ntz") + F.expr("interval 23 hours"),
        F.expr("interval 1 hour"),
    )
    hourly = F.struct(
        F.transform(hours, lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.col("h.value").alias("value"),
    )
    payloads = units.select(
        "event_type", "day", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload")
    )
    parsed = with_series(payloads, {"value": "value"}, "event_type")
    return refused_units(parsed, ["event_type", "day"])


def new_series(spark, folder):
    """Series in the payload that only ``wind_speed_10m`` is read from."""
    parsed = with_series(
        weather_payloads(by_user(table(spark, folder, "events"))), {"value": "wind_speed_10m"}, "city_id"
    )
    found = unknown_series(parsed, {"value": "wind_speed_10m"}, ["city_id"])
    return found.groupBy("city_id", "field").agg(F.count(F.lit(1)).alias("units"))


def responses(spark, folder):
    """A response log: the status follows from ``k``, some bodies are cut short."""
    events = table(spark, folder, "events").select("event_id", "props", prop_k().alias("k"))
    k = F.col("k")
    status = (
        F.when(k < 60, 200).when(k < 70, 429).when(k < 80, 503).when(k < 90, 400).when(k >= 95, 200)
    )
    body = F.when(k >= 95, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    log = events.select("event_id", status.alias("status"), body.alias("body"))
    return classify_responses(log).select("event_id", "outcome", "problem")


def bounds(spark, folder):
    rules = (
        Bound("c_name", pattern=r"^Customer#[0-9]+$"),
        Bound("c_mktsegment", length=8),
        Bound("c_acctbal", min=-900, max=9900),
    )
    found = out_of_bounds(table(spark, folder, "customer"), rules)
    return found.select("c_custkey", F.array_join("_broken", ",").alias("broken"))


def catalogue_scan(spark, folder):
    """Customers written as a CSV catalogue, read with its schema and bounds."""
    path = scratch_path(spark, "catalogue")
    customers_as_cities(spark, folder).write.csv(path, header=True)
    return read_catalogue(spark, path)


def batch_ids(spark, folder):
    units = events_by_day(spark, folder).select(*UNIT).distinct()
    return units.withColumn("batch_id", batch_id("event_type", "day"))


def payload_hashes(spark, folder):
    return table(spark, folder, "events").select("event_id", payload_hash("props").alias("hash"))


def surrogate_keys(spark, folder):
    keys = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return keys.withColumn("line_key", surrogate_key(keys, ["l_orderkey", "l_linenumber"]))


def distinct_rows(spark, folder):
    """Rows told apart by a hash over all columns."""
    nation = table(spark, folder, "customer").select("c_nationkey", "c_mktsegment")
    hashed = nation.withColumn("h", row_hash("c_nationkey", "c_mktsegment"))
    return hashed.agg(F.count_distinct("h").alias("n"))


_LANDED = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("_source_payload_hash", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("event_type", T.StringType()),
    ]
)


def _landing(spark, folder):
    """Days up to the 20th land first, then days from the 15th on land again."""
    path = scratch_path(spark, "landing")
    rows = events_by_day(spark, folder).select("event_id", "value", "day", "event_type")
    first = rows.filter(F.col("day") <= F.lit("2024-01-20").cast("date"))
    again = rows.filter(F.col("day") >= F.lit("2024-01-15").cast("date"))
    land(first.withColumn("_source_payload_hash", F.lit("first")), path, UNIT[::-1])
    land(again.withColumn("_source_payload_hash", F.lit("again")), path, UNIT[::-1])
    return read_landed(spark, path, _LANDED)


def land_rerun(spark, folder):
    return _landing(spark, folder).select("event_id", "event_type", "day", "value")


def hashes(spark, folder):
    return landed_hashes(_landing(spark, folder), UNIT).withColumnRenamed(
        "_source_payload_hash", "hash"
    )


def _bucketed(spark, folder):
    """The same landings for (day, user) units, which share folders by bucket."""
    path = scratch_path(spark, "landing")
    events = by_user(table(spark, folder, "events")).withColumn("day", F.to_date("ts"))
    rows = events.select("event_id", "value", "day", "event_type")
    first = rows.filter(F.col("day") <= F.lit("2024-01-20").cast("date"))
    again = rows.filter((F.col("day") >= F.lit("2024-01-15").cast("date")) & (F.col("event_id") % 2 == 0))
    for name, batch in (("first", first), ("again", again)):
        units = batch.select("day", "event_type").distinct()
        land_units(batch.withColumn("_source_payload_hash", F.lit(name)), path, ["day", "event_type"], units, buckets=4)
    return read_landed(spark, path, _LANDED)


def land_shared(spark, folder):
    return _bucketed(spark, folder).select("event_id", "event_type", "day", "_source_payload_hash")


def shared_folders(spark, folder):
    """Folders per day: as many as buckets have rows, whatever the number of users."""
    path = scratch_path(spark, "landing")
    events = by_user(table(spark, folder, "events")).withColumn("day", F.to_date("ts"))
    rows = events.select("event_id", "value", "day", "event_type")
    units = rows.select("day", "event_type").distinct()
    land_units(rows, path, ["day", "event_type"], units, buckets=1)
    landed = spark.read.schema(_LANDED).parquet(path)
    file = F.col("_metadata.file_path")
    return landed.select("day", F.regexp_replace(file, "/[^/]*$", "").alias("place")).groupBy("day").agg(
        F.count_distinct("place").alias("folders"), F.count(F.lit(1)).alias("rows")
    )


def quarantine_roundtrip(spark, folder):
    """Rejected events go out as JSON lines and come back."""
    path = scratch_path(spark, "quarantine")
    rejected = split_valid(events_by_day(spark, folder), EVENT)[1]
    lines = quarantine_lines(rejected, EVENT, UNIT, datetime(2024, 2, 1))
    write_quarantine(lines, path, UNIT[::-1])
    unit = T.StructType(
        [T.StructField("event_type", T.StringType()), T.StructField("day", T.DateType())]
    )
    return read_quarantine(spark, path, unit).select(
        "event_type",
        "day",
        F.col("_contract").alias("contract"),
        F.array_join("_reasons", ";").alias("reasons"),
        F.get_json_object("row", "$.event_id").cast("long").alias("event_id"),
    )


def versions(spark, folder):
    """Version 1 of a feed before the 15th, version 2 with a renamed field from then on."""
    events = table(spark, folder, "events")
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    old = events.filter(F.col("ts") < split).select("event_id", F.col("value").alias("amount"))
    new = events.filter(F.col("ts") >= split).select(
        "event_id", (F.col("value") * 100).alias("cents"), "event_type"
    )
    return union_versions(
        [
            (old, {"event_id": F.col("event_id"), "value": F.col("amount"), "version": F.lit(1)}),
            (
                new,
                {
                    "event_id": F.col("event_id"),
                    "value": F.round(F.col("cents") / 100, 2),
                    "version": F.lit(2),
                    "event_type": F.col("event_type"),
                },
            ),
        ]
    )


def _flat_sql(source):
    return f"""
    SELECT event_type AS city_id, strftime(hour, '%Y-%m-%dT%H:%M') AS observed_at, value, k
    FROM ({READINGS_SQL.format(source=source)})
"""


_K = "CAST(json_extract(props, '$.k') AS INTEGER)"

QUERIES = {
    "flatten_series": Query(flatten, _flat_sql(BY_USER)),
    "payload_files": Query(payload_files, _flat_sql("events")),
    "ragged_units": Query(
        ragged,
        f"""
        SELECT event_type, day,
               event_type || ': series ''value'' holds ' || count(*) || ' values for 24 times'
                   AS problem
        FROM ({READINGS_SQL.format(source=BY_USER)})
        GROUP BY event_type, day HAVING count(*) <> 24
        """,
    ),
    "unknown_series": Query(
        new_series,
        f"""
        SELECT event_type AS city_id, field, count(DISTINCT CAST(ts AS DATE)) AS units
        FROM {BY_USER}, (SELECT unnest(['temperature_2m', 'relative_humidity_2m', 'precipitation',
                                     'weather_code']) AS field)
        GROUP BY ALL
        """,
    ),
    "classify_responses": Query(
        responses,
        f"""
        WITH log AS (
            SELECT event_id,
                   CASE WHEN {_K} < 60 THEN 200 WHEN {_K} < 70 THEN 429 WHEN {_K} < 80 THEN 503
                        WHEN {_K} < 90 THEN 400 WHEN {_K} >= 95 THEN 200 END AS status,
                   CASE WHEN {_K} >= 95 THEN left(props, length(props) - 1) ELSE props END AS body
            FROM events)
        SELECT event_id,
               CASE WHEN status IS NULL OR status = 429 OR status >= 500 THEN 'transient'
                    WHEN status >= 400 THEN 'permanent'
                    WHEN json_valid(body) THEN 'ok' ELSE 'transient' END AS outcome,
               CASE WHEN status IS NULL THEN 'transport failure'
                    WHEN status = 429 THEN 'rate limited'
                    WHEN status >= 400 THEN 'returned ' || status
                    WHEN NOT json_valid(body) THEN 'non-JSON body' END AS problem
        FROM log
        """,
    ),
    "catalogue_bounds": Query(
        bounds,
        """
        SELECT c_custkey, concat_ws(',',
                   CASE WHEN NOT regexp_matches(c_name, '^Customer#[0-9]+$') THEN 'c_name' END,
                   CASE WHEN length(c_mktsegment) <> 8 THEN 'c_mktsegment' END,
                   CASE WHEN c_acctbal NOT BETWEEN -900 AND 9900 THEN 'c_acctbal' END) AS broken
        FROM customer
        WHERE NOT regexp_matches(c_name, '^Customer#[0-9]+$') OR length(c_mktsegment) <> 8
           OR c_acctbal NOT BETWEEN -900 AND 9900
        """,
    ),
    "catalogue_scan": Query(
        catalogue_scan,
        """
        SELECT CAST(c_custkey AS VARCHAR) AS city_id, c_name AS name,
               upper(substr(n_name, 1, 2)) AS country_code,
               CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
               c_mktsegment AS timezone_name, CAST(round(c_acctbal * 1000) AS BIGINT) AS population
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "batch_ids": Query(
        batch_ids,
        """
        SELECT DISTINCT event_type, CAST(ts AS DATE) AS day,
               substr(sha256(event_type || '|' || strftime(ts, '%Y-%m-%d') || '|v1'), 1, 32)
                   AS batch_id
        FROM events
        """,
    ),
    "payload_hashes": Query(
        payload_hashes,
        f"""SELECT event_id, sha256('{{"k":' || {_K} || '}}') AS hash FROM events""",
    ),
    "surrogate_keys": Query(
        surrogate_keys,
        """
        SELECT DISTINCT l_orderkey, l_linenumber,
               md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)) AS line_key
        FROM lineitem
        """,
    ),
    "row_hashes": Query(
        distinct_rows,
        "SELECT count(*) AS n FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)",
    ),
    "land_rerun": Query(
        land_rerun,
        "SELECT event_id, event_type, CAST(ts AS DATE) AS day, value FROM events",
    ),
    "landed_hashes": Query(
        hashes,
        """
        SELECT DISTINCT event_type, CAST(ts AS DATE) AS day,
               CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN 'again' ELSE 'first' END AS hash
        FROM events
        """,
    ),
    "land_units": Query(
        land_shared,
        f"""
        WITH rows AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM {BY_USER}),
        again AS (SELECT * FROM rows WHERE day >= DATE '2024-01-15' AND event_id % 2 = 0)
        SELECT *, 'again' AS _source_payload_hash FROM again
        UNION ALL
        SELECT *, 'first' FROM rows r WHERE day <= DATE '2024-01-20' AND NOT EXISTS (
            SELECT 1 FROM again a WHERE a.day = r.day AND a.event_type = r.event_type)
        """,
    ),
    "land_folders": Query(
        shared_folders,
        """
        SELECT CAST(ts AS DATE) AS day, CAST(1 AS BIGINT) AS folders, count(*) AS rows
        FROM events GROUP BY CAST(ts AS DATE)
        """,
    ),
    "quarantine_roundtrip": Query(
        quarantine_roundtrip,
        """
        SELECT event_type, CAST(ts AS DATE) AS day, 'event.v1' AS contract,
               'value: ' || CAST(value AS VARCHAR) || ' above contract maximum 200' AS reasons,
               event_id
        FROM events WHERE value > 200
        """,
    ),
    "union_versions": Query(
        versions,
        """
        SELECT event_id, value, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS version,
               CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN event_type END AS event_type
        FROM events
        """,
    ),
}
