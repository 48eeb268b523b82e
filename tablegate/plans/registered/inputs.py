"""Stand-ins for the weather tables, derived from the driver's tables.

An event is a reading: its type or its user is the entity, ``value`` the
measure, ``props`` the payload, and its time the ingestion time. Several events
of an entity in one hour are duplicates of the grain, the latest one counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.functions import batch_id, hour_start
from tablegate.operators.dedupe import dedupe_latest


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_user(events: DataFrame) -> DataFrame:
    """The events with their user as entity, so that entities grow with the data."""
    return events.withColumn("event_type", F.col("user_id").cast("string"))


BY_USER = "(SELECT * REPLACE (CAST(user_id AS VARCHAR) AS event_type) FROM events)"


def prop_k() -> Column:
    """The one number in ``props``."""
    return F.get_json_object("props", "$.k").cast("int")


def readings(events: DataFrame, *extra: str) -> DataFrame:
    """Latest event per (event_type, hour)."""
    rows = events.select(
        "event_type",
        hour_start("ts").alias("hour"),
        F.to_date("ts").alias("day"),
        "ts",
        "event_id",
        "value",
        *extra,
    )
    return dedupe_latest(rows, ["event_type", "hour"], ["ts", "event_id"])


READINGS_SQL = """
    SELECT event_type, date_trunc('hour', ts) AS hour, CAST(ts AS DATE) AS day, ts, event_id,
           value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
    FROM {source}
    QUALIFY row_number() OVER (
        PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1
"""


def observations(events: DataFrame, entity: str) -> DataFrame:
    """Rows shaped like the raw table, with ``entity`` as the city."""
    city, k = F.col(entity).cast("string"), F.col("k")
    return events.withColumn("k", prop_k()).select(
        city.alias("city_id"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        hour_start("ts").alias("observed_at_utc"),
        F.to_date("ts").alias("observation_date"),
        (F.col("value") - 20).alias("temperature_2m_c"),
        k.cast("double").alias("relative_humidity_2m_pct"),
        F.greatest(F.col("value") - 50, F.lit(0.0)).alias("precipitation_mm"),
        F.col("value").alias("wind_speed_10m_kmh"),
        k.alias("weather_code"),
        F.col("ts").alias("_ingested_at_utc"),
        batch_id(city, F.to_date("ts")).alias("_batch_id"),
        F.sha2("props", 256).alias("_source_payload_hash"),
        F.lit(1).alias("_contract_version"),
    )


# The staged rows of `observations`, as SQL.
STAGED_SQL = """
    SELECT CAST({entity} AS VARCHAR) AS city_id, date_trunc('hour', ts) AS observed_at_utc,
           CAST(ts AS DATE) AS observation_date, value - 20 AS temperature_c,
           CAST(json_extract(props, '$.k') AS DOUBLE) AS relative_humidity_pct,
           greatest(value - 50, 0.0) AS precipitation_mm, value AS wind_speed_kmh,
           CAST(json_extract(props, '$.k') AS BIGINT) AS weather_code, ts AS ingested_at_utc
    FROM {source}
    QUALIFY row_number() OVER (
        PARTITION BY {entity}, date_trunc('hour', ts) ORDER BY ts DESC) = 1
"""


def customers_as_cities(spark: SparkSession, folder: str) -> DataFrame:
    """A catalogue: customers as cities, their nation as country."""
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("city_id"),
        F.col("c_name").alias("name"),
        F.upper(F.substring("n_name", 1, 2)).alias("country_code"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        F.col("c_mktsegment").alias("timezone_name"),
        F.round(F.col("c_acctbal") * 1000).cast("long").alias("population"),
    )


CITIES_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS city_id, c_name AS city_name,
           upper(substr(n_name, 1, 2)) AS country_code, CAST(n_nationkey AS DOUBLE) AS latitude,
           CAST(n_regionkey AS DOUBLE) AS longitude, c_mktsegment AS timezone_name,
           CAST(round(c_acctbal * 1000) AS BIGINT) AS population,
           CASE WHEN CAST(round(c_acctbal * 1000) AS BIGINT) >= 2000000 THEN 'large'
                WHEN CAST(round(c_acctbal * 1000) AS BIGINT) >= 1000000 THEN 'medium'
                ELSE 'small' END AS size_band
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def exact_avg_sql(column: str) -> str:
    """Average of a two-digit measure, rounded half away from zero, in integers."""
    total = f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS HUGEINT)"
    return (
        f"CAST(sign({total}) * ((2 * abs({total}) + count({column})) // (2 * count({column})))"
        f" AS DOUBLE) / 100"
    )


def exact_sum_sql(column: str) -> str:
    return f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / 100"


def event_types_as_cities(events: DataFrame) -> DataFrame:
    """A catalogue of the event types."""
    return events.select(
        F.col("event_type").alias("city_id"),
        F.initcap("event_type").alias("name"),
        F.upper(F.substring("event_type", 1, 2)).alias("country_code"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.lit("UTC").alias("timezone_name"),
        F.lit(0).cast("long").alias("population"),
    ).distinct()


def weather_payloads(events: DataFrame) -> DataFrame:
    """One payload per (event_type, day), as the producer would have sent it.

    Readings are one per hour, so each document gathers at most 24 of them.
    """
    entry = F.struct(F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("t"), "value", "k")
    rows = readings(events, "props").withColumn("k", prop_k())
    units = rows.groupBy(F.col("event_type").alias("city_id"), F.col("day").alias("observation_date"))
    hours = units.agg(F.sort_array(F.collect_list(entry)).alias("h"))
    series = F.struct(
        F.col("h.t").alias("time"),
        F.transform("h.value", lambda v: v / 4).alias("temperature_2m"),
        F.col("h.k").alias("relative_humidity_2m"),
        F.transform("h.value", lambda v: F.greatest(v - 50, F.lit(0.0))).alias("precipitation"),
        F.col("h.value").alias("wind_speed_10m"),
        F.col("h.k").alias("weather_code"),
    )
    return hours.select(
        "observation_date",
        "city_id",
        F.to_json(F.struct(F.lit(1.5).alias("latitude"), series.alias("hourly"))).alias("payload"),
    )
