"""Staging, fact, daily aggregate and dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tablegate.functions import band
from tablegate.operators.joins import small
from tablegate.operators.merge import incremental_merge
from tablegate.plans.marts import (
    DAILY_GRAIN,
    agg_weather_daily,
    coverage,
    dim_city,
    fct_weather_hourly,
    merged_daily,
    stage_cities,
    stage_observations,
)
from tablegate.plans.registered import Query
from tablegate.plans.registered.inputs import (
    CITIES_SQL,
    STAGED_SQL,
    by_user,
    customers_as_cities,
    event_types_as_cities,
    exact_avg_sql,
    exact_sum_sql,
    observations,
    table,
)
from tablegate.session import scratch_path


def raw(spark, folder, entity="user_id"):
    return observations(table(spark, folder, "events"), entity)


def fact(spark, folder):
    """Readings of users who are customers; other users are unknown cities."""
    cities = stage_cities(customers_as_cities(spark, folder))
    return fct_weather_hourly(stage_observations(raw(spark, folder)), cities)


def fact_by_type(spark, folder):
    events = table(spark, folder, "events")
    cities = small(stage_cities(event_types_as_cities(events)))
    return fct_weather_hourly(stage_observations(raw(spark, folder, "event_type")), cities)


def fact_by_user(spark, folder):
    """The same with users as cities, so that entities grow with the data."""
    cities = small(stage_cities(event_types_as_cities(by_user(table(spark, folder, "events")))))
    return fct_weather_hourly(stage_observations(raw(spark, folder)), cities)


def staged(spark, folder):
    return stage_observations(raw(spark, folder)).select(
        "city_id", "observed_at_utc", "observation_date", "temperature_c", "relative_humidity_pct",
        "precipitation_mm", "wind_speed_kmh", "weather_code", "ingested_at_utc",
    )


def hourly_fact(spark, folder):
    return fact(spark, folder).select(
        "city_id", "city_name", "country_code", "observed_at_utc", "observation_date",
        "observed_hour_utc", "hour_of_day_utc", "day_of_week_iso", "temperature_c",
        "precipitation_mm", "is_wet_hour", "is_freezing_hour", "ingested_at_utc",
    )


def daily(spark, folder):
    return agg_weather_daily(fact(spark, folder)).drop("dbt_updated_at")


def daily_of_all(spark, folder):
    return agg_weather_daily(fact_by_user(spark, folder)).drop("dbt_updated_at")


def size_band(spark, folder):
    bands = ((980, "large"), (940, "medium"))
    return table(spark, folder, "part").select(
        "p_partkey", band("p_retailprice", bands, "small").alias("size_band")
    )


def dimension(spark, folder):
    return dim_city(stage_cities(customers_as_cities(spark, folder)), coverage(raw(spark, folder)))


def dim_coverage(spark, folder):
    """Nations with their well-off customers; most nations have few or none."""
    rich = table(spark, folder, "customer").filter(F.col("c_acctbal") > 9900)
    covered = rich.groupBy(F.col("c_nationkey").alias("city_id")).agg(
        F.min("c_acctbal").alias("lowest"),
        F.max("c_acctbal").alias("highest"),
        F.count(F.lit(1)).alias("observation_count"),
    )
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("city_id"), "n_name")
    return dim_city(nations, covered)


def _early(spark, folder):
    """The daily aggregate as of noon of the 20th, and all readings."""
    hourly = fact_by_user(spark, folder)
    before = F.col("observed_at_utc") < F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return agg_weather_daily(hourly.filter(before)).drop("dbt_updated_at"), hourly


def incremental(spark, folder):
    """One incremental run brings the early aggregate up to date."""
    return merged_daily(*_early(spark, folder)).drop("_action")


def stored_incremental(spark, folder):
    """The same against a stored mart: written early, then merged with a window."""
    path = scratch_path(spark, "daily")
    early, hourly = _early(spark, folder)
    incremental_merge(spark, path, early, DAILY_GRAIN, "observation_date")
    window = hourly.filter(F.col("observation_date") >= F.lit(date(2024, 1, 13)))
    rebuilt = agg_weather_daily(window).drop("dbt_updated_at")
    incremental_merge(spark, path, rebuilt, DAILY_GRAIN, "observation_date")
    return spark.read.schema(early.schema).parquet(path)


FACT_SQL = f"""
    WITH staged AS ({STAGED_SQL.format(entity="user_id", source="events")}),
    cities AS ({CITIES_SQL}),
    fact AS (
        SELECT s.*, c.city_name, c.country_code, s.observed_at_utc AS observed_hour_utc,
               CAST(hour(s.observed_at_utc) AS INTEGER) AS hour_of_day_utc,
               CAST(isodow(s.observation_date) AS INTEGER) AS day_of_week_iso,
               s.precipitation_mm > 0 AS is_wet_hour, s.temperature_c < 0 AS is_freezing_hour
        FROM staged s JOIN cities c ON s.city_id = c.city_id)
"""
def _entity_fact_sql(entity):
    return f"""
    WITH fact AS (
        SELECT *, upper(city_id[1]) || city_id[2:] AS city_name, upper(city_id[1:2]) AS country_code,
               precipitation_mm > 0 AS is_wet_hour, temperature_c < 0 AS is_freezing_hour
        FROM ({STAGED_SQL.format(entity=entity, source="events")}))
"""


TYPE_FACT_SQL, USER_FACT_SQL = _entity_fact_sql("event_type"), _entity_fact_sql("user_id")
DAILY_SQL = f"""
    SELECT city_id, observation_date, any_value(city_name) AS city_name,
           any_value(country_code) AS country_code, count(*) AS hours_observed,
           count(*) = 24 AS is_complete_day, {exact_avg_sql("temperature_c")} AS avg_temperature_c,
           round(min(temperature_c), 2) AS min_temperature_c,
           round(max(temperature_c), 2) AS max_temperature_c,
           {exact_avg_sql("relative_humidity_pct")} AS avg_relative_humidity_pct,
           {exact_sum_sql("precipitation_mm")} AS total_precipitation_mm,
           round(max(wind_speed_kmh), 2) AS max_wind_speed_kmh,
           count(*) FILTER (WHERE is_wet_hour) AS wet_hours,
           count(*) FILTER (WHERE is_freezing_hour) AS freezing_hours,
           count(*) FILTER (WHERE temperature_c IS NULL) AS hours_missing_temperature,
           max(ingested_at_utc) AS last_ingested_at_utc
    FROM fact GROUP BY city_id, observation_date
"""

QUERIES = {
    "stage_observations": Query(staged, STAGED_SQL.format(entity="user_id", source="events")),
    "stage_cities": Query(
        lambda spark, folder: stage_cities(customers_as_cities(spark, folder)), CITIES_SQL
    ),
    "hourly_fact": Query(
        hourly_fact,
        FACT_SQL
        + """
        SELECT city_id, city_name, country_code, observed_at_utc, observation_date,
               observed_hour_utc, hour_of_day_utc, day_of_week_iso, temperature_c,
               precipitation_mm, is_wet_hour, is_freezing_hour, ingested_at_utc
        FROM fact
        """,
    ),
    "daily_rollup": Query(daily_of_all, USER_FACT_SQL + DAILY_SQL),
    "daily_rollup_by_user": Query(daily, FACT_SQL + DAILY_SQL),
    "size_band": Query(
        size_band,
        """
        SELECT p_partkey, CASE WHEN p_retailprice >= 980 THEN 'large'
                               WHEN p_retailprice >= 940 THEN 'medium' ELSE 'small' END AS size_band
        FROM part
        """,
    ),
    "dim_city": Query(
        dimension,
        f"""
        WITH cities AS ({CITIES_SQL}),
        covered AS (
            SELECT CAST(user_id AS VARCHAR) AS city_id, min(CAST(ts AS DATE)) AS first_observation_date,
                   max(CAST(ts AS DATE)) AS last_observation_date,
                   count(DISTINCT date_trunc('hour', ts)) AS observation_count
            FROM events GROUP BY user_id)
        SELECT cities.*, first_observation_date, last_observation_date,
               coalesce(observation_count, 0) AS observation_count,
               covered.city_id IS NOT NULL AS has_observations
        FROM cities LEFT JOIN covered ON cities.city_id = covered.city_id
        """,
    ),
    "dim_coverage": Query(
        dim_coverage,
        """
        SELECT n_nationkey AS city_id, n_name, min(c_acctbal) AS lowest, max(c_acctbal) AS highest,
               count(c_custkey) AS observation_count, count(c_custkey) > 0 AS has_observations
        FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey AND c_acctbal > 9900
        GROUP BY ALL
        """,
    ),
    "incremental_merge": Query(incremental, USER_FACT_SQL + DAILY_SQL),
    "incremental_merge_stored": Query(stored_incremental, USER_FACT_SQL + DAILY_SQL),
}
