"""Staging, dimension, hourly fact and daily aggregate."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.functions import (
    band,
    exact_avg,
    exact_sum,
    hour_start,
    iso_weekday,
    surrogate_key,
    utc_literal,
)
from tablegate.operators.checks import HOURS_PER_DAY
from tablegate.operators.dedupe import dedupe_latest
from tablegate.operators.incremental import (
    RESTATEMENT_DAYS,
    restated_days,
    restatement_filter,
    stored_cutoff,
)
from tablegate.operators.joins import semi_join, small
from tablegate.operators.merge import incremental_merge, merge_rows, named_partitions
from tablegate.session import materialize
from tablegate.sources.publish import read_table

# Staging names and types of the landed columns, size bands.
STAGING_COLUMNS = (
    ("city_id", "city_id", "string"),
    ("observed_at_utc", "observed_at_utc", "timestamp_ntz"),
    ("observation_date", "observation_date", "date"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("temperature_2m_c", "temperature_c", "double"),
    ("relative_humidity_2m_pct", "relative_humidity_pct", "double"),
    ("precipitation_mm", "precipitation_mm", "double"),
    ("wind_speed_10m_kmh", "wind_speed_kmh", "double"),
    ("weather_code", "weather_code", "bigint"),
    ("_ingested_at_utc", "ingested_at_utc", "timestamp_ntz"),
    ("_batch_id", "batch_id", "string"),
    ("_source_payload_hash", "source_payload_hash", "string"),
    ("_contract_version", "contract_version", "bigint"),
)
SIZE_BANDS = ((2_000_000, "large"), (1_000_000, "medium"))
SMALLEST_BAND = "small"
GRAIN = ["city_id", "observed_at_utc"]
DAILY_GRAIN = ["city_id", "observation_date"]


def stage_observations(raw: DataFrame) -> DataFrame:
    """Renamed, cast and reduced to one row per (city, hour).

    Filter ``raw`` by ``observation_date`` before this call: that column is no
    key of the dedupe, so a later filter would not reach the scan.
    """
    renamed = raw.dropna(subset=GRAIN).select(
        *[F.col(source).cast(kind).alias(name) for source, name, kind in STAGING_COLUMNS]
    )
    latest = dedupe_latest(renamed, GRAIN, ["ingested_at_utc"])
    return latest.select(surrogate_key(latest, GRAIN).alias("observation_key"), "*")


def stage_cities(catalogue: DataFrame) -> DataFrame:
    return catalogue.select(
        "city_id",
        F.col("name").alias("city_name"),
        "country_code",
        "latitude",
        "longitude",
        "timezone_name",
        "population",
        band("population", SIZE_BANDS, SMALLEST_BAND).alias("size_band"),
    )


def coverage(raw: DataFrame) -> DataFrame:
    """First day, last day and number of distinct hours per city.

    Equal to counting staged rows, but reads three columns and counts distinct
    keys instead of picking the latest whole row of each.
    """
    return (
        raw.dropna(subset=GRAIN)
        .groupBy("city_id")
        .agg(
            F.min("observation_date").alias("first_observation_date"),
            F.max("observation_date").alias("last_observation_date"),
            F.count_distinct("observed_at_utc").alias("observation_count"),
        )
    )


def dim_city(cities: DataFrame, covered: DataFrame) -> DataFrame:
    """Every catalogue city, with its coverage or none."""
    joined = cities.join(covered, "city_id", "left")
    return joined.withColumns(
        {
            "has_observations": F.col("observation_count").isNotNull(),
            "observation_count": F.coalesce("observation_count", F.lit(0)),
        }
    )


def _updated_at(as_of: datetime | None) -> Column:
    return utc_literal(as_of or datetime.now(tz=UTC)).alias("dbt_updated_at")


def fct_weather_hourly(
    observations: DataFrame, cities: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """Readings with names, time parts and flags; unknown cities drop out."""
    names = cities.select("city_id", "city_name", "country_code")
    return observations.join(names, "city_id").select(
        "observation_key",
        "city_id",
        "city_name",
        "country_code",
        "observed_at_utc",
        "observation_date",
        hour_start("observed_at_utc").alias("observed_hour_utc"),
        F.hour("observed_at_utc").alias("hour_of_day_utc"),
        iso_weekday("observation_date").alias("day_of_week_iso"),
        "temperature_c",
        "relative_humidity_pct",
        "precipitation_mm",
        "wind_speed_kmh",
        "weather_code",
        (F.col("precipitation_mm") > 0).alias("is_wet_hour"),
        (F.col("temperature_c") < 0).alias("is_freezing_hour"),
        "batch_id",
        "source_payload_hash",
        "contract_version",
        "ingested_at_utc",
        _updated_at(as_of),
    )


def agg_weather_daily(
    hourly: DataFrame, expected_hours: int = HOURS_PER_DAY, as_of: datetime | None = None
) -> DataFrame:
    """One row per (city, day); incomplete days are kept and flagged."""
    daily = hourly.groupBy(*DAILY_GRAIN).agg(
        F.any_value("city_name").alias("city_name"),
        F.any_value("country_code").alias("country_code"),
        F.count(F.lit(1)).alias("hours_observed"),
        (F.count(F.lit(1)) == expected_hours).alias("is_complete_day"),
        exact_avg("temperature_c").alias("avg_temperature_c"),
        F.round(F.min("temperature_c"), 2).alias("min_temperature_c"),
        F.round(F.max("temperature_c"), 2).alias("max_temperature_c"),
        exact_avg("relative_humidity_pct").alias("avg_relative_humidity_pct"),
        exact_sum("precipitation_mm").alias("total_precipitation_mm"),
        F.round(F.max("wind_speed_kmh"), 2).alias("max_wind_speed_kmh"),
        F.count_if("is_wet_hour").alias("wet_hours"),
        F.count_if("is_freezing_hour").alias("freezing_hours"),
        F.count_if(F.col("temperature_c").isNull()).alias("hours_missing_temperature"),
        F.max("ingested_at_utc").alias("last_ingested_at_utc"),
    )
    return daily.select("*", _updated_at(as_of))


def publish_views(frames: dict[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def _mart(spark: SparkSession, root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def build_marts(
    spark: SparkSession,
    raw: DataFrame,
    catalogue: DataFrame,
    root: str,
    window_days: int = RESTATEMENT_DAYS,
    days: tuple[date, date] | None = None,
    as_of: datetime | None = None,
    units: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Staging views, then dimension, fact and daily aggregate below ``root``.

    The dimension is rebuilt whole. Fact and aggregate rebuild the window that
    ends at their own newest day, or everything on the first run; the newest day is a
    folder name, so no data is read to find it. ``days`` names an affected range instead,
    and ``units`` the affected (city, day) themselves, as a backfill of old days must:
    those lie before the window.
    """
    cities = small(stage_cities(catalogue))
    dim_city(cities, coverage(raw)).write.mode("overwrite").parquet(_mart(spark, root, "dim_city"))
    affected = None if units is None else materialize(units.select(*DAILY_GRAIN).distinct())

    fact_path = _mart(spark, root, "fct_weather_hourly")
    recent = _window(raw, fact_path, window_days, days, affected)
    fact_rows = fct_weather_hourly(stage_observations(recent), cities, as_of)
    incremental_merge(spark, fact_path, fact_rows, ["observation_key"], "observation_date")

    daily_path = _mart(spark, root, "agg_weather_daily")
    fact = read_table(spark, fact_path)
    if fact is None:
        fact = fact_rows.limit(0)
    recent = _window(fact, daily_path, window_days, days, affected)
    daily_rows = agg_weather_daily(recent, as_of=as_of)
    incremental_merge(spark, daily_path, daily_rows, DAILY_GRAIN, "observation_date")

    daily = read_table(spark, daily_path)
    marts = {
        "stg_weather__observations": stage_observations(raw),
        "stg_weather__cities": cities,
        "dim_city": read_table(spark, _mart(spark, root, "dim_city")),
        "fct_weather_hourly": fact,
        "agg_weather_daily": daily_rows.limit(0) if daily is None else daily,
    }
    publish_views(marts)
    return marts


def rebuild_marts(
    spark: SparkSession,
    raw: DataFrame,
    catalogue: DataFrame,
    root: str,
    first: date,
    last: date,
    as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """One rebuild after a backfill of ``first`` to ``last``."""
    return build_marts(spark, raw, catalogue, root, days=(first, last), as_of=as_of)


def rebuild_units(
    spark: SparkSession,
    raw: DataFrame,
    catalogue: DataFrame,
    root: str,
    units: DataFrame,
    as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """One rebuild after a backfill of any (city, day), however far apart.

    Their days are named one by one, so only their partitions are read and written; days
    between them are not touched, nor are the other cities' rows rebuilt.
    """
    return build_marts(spark, raw, catalogue, root, as_of=as_of, units=units)


def _window(rows, mart_path, window_days, days, affected) -> DataFrame:
    if affected is not None:
        inside = named_partitions(affected.select("observation_date").distinct(), "observation_date")
        return rows.limit(0) if inside is None else semi_join(inside(rows), affected, DAILY_GRAIN)
    if days is not None:
        return restated_days(rows, "observation_date", *days)
    first = stored_cutoff(rows.sparkSession, mart_path, "observation_date", window_days)
    return rows.filter(F.col("observation_date") >= F.lit(first))


def merged_daily(
    daily: DataFrame, hourly: DataFrame, window_days: int = RESTATEMENT_DAYS
) -> DataFrame:
    """The daily aggregate after one incremental run, without writing it."""
    rebuilt = agg_weather_daily(
        restatement_filter(hourly, "observation_date", daily, window_days)
    ).select(daily.columns)
    return merge_rows(daily, rebuilt, DAILY_GRAIN)

