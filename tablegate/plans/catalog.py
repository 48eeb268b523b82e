"""Marts and staging by name: tables and views of the session's catalog.

Tables are external, over the folders that the marts are stored in, so publishing them
copies nothing. Views are stored as SQL and outlive the session where the catalog does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tablegate.functions.identity import KEY_SEPARATOR, NULL_KEY
from tablegate.plans.marts import GRAIN, SIZE_BANDS, SMALLEST_BAND, STAGING_COLUMNS
from tablegate.sources.publish import Folder, read_table, recover


def publish_table(
    spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = ()
) -> None:
    """(Re)define an external table over a stored one, with all of its partitions."""
    recover(spark, path)
    stored = read_table(spark, path)
    if stored is None:
        raise ValueError(f"nothing is stored at {path}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    location = Folder(spark, path).root.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitions} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def staged_observations_sql(raw: str) -> str:
    """The staging projection of the raw table ``raw``: renamed, cast, one row per grain."""
    columns = ", ".join(f"CAST({source} AS {kind}) AS {name}" for source, name, kind in STAGING_COLUMNS)
    present = " AND ".join(f"{c} IS NOT NULL" for c in GRAIN)
    ties = [name for _, name, _ in STAGING_COLUMNS if name not in (*GRAIN, "ingested_at_utc")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("ingested_at_utc", *ties))
    moment = "CAST(observed_at_utc AS STRING)"
    # A whole second is printed without its fraction; the key has six digits of it.
    moment = f"rpad(IF(length({moment}) = 19, {moment} || '.', {moment}), 26, '0')"
    key = ", ".join(f"coalesce({text}, '{NULL_KEY}')" for text in ("city_id", moment))
    names = ", ".join(name for _, name, _ in STAGING_COLUMNS)
    return f"""
        SELECT md5(concat_ws('{KEY_SEPARATOR}', {key})) AS observation_key, {names}
        FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(GRAIN)} ORDER BY {order}) AS _row_number
              FROM (SELECT {columns} FROM {raw} WHERE {present}))
        WHERE _row_number = 1
    """


def staged_cities_sql(cities: str) -> str:
    bands = " ".join(f"WHEN population >= {least} THEN '{label}'" for least, label in SIZE_BANDS)
    return f"""
        SELECT city_id, name AS city_name, country_code, latitude, longitude, timezone_name,
               population, CASE {bands} ELSE '{SMALLEST_BAND}' END AS size_band
        FROM {cities}
    """


def publish_catalog(
    spark: SparkSession, database: str, raw_path: str, cities_path: str, marts_root: str
) -> list[str]:
    """Everything by name in ``database``: raw and marts as tables, staging as views."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    root, day = marts_root.rstrip("/"), ["observation_date"]
    publish_table(spark, f"{database}.weather_observation", raw_path, day)
    publish_table(spark, f"{database}.city_catalogue", cities_path)
    publish_table(spark, f"{database}.dim_city", f"{root}/dim_city")
    publish_table(spark, f"{database}.fct_weather_hourly", f"{root}/fct_weather_hourly", day)
    publish_table(spark, f"{database}.agg_weather_daily", f"{root}/agg_weather_daily", day)
    views = {
        "stg_weather__observations": staged_observations_sql(f"{database}.weather_observation"),
        "stg_weather__cities": staged_cities_sql(f"{database}.city_catalogue"),
    }
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
    return [row.tableName for row in spark.sql(f"SHOW TABLES IN {database}").collect() if not row.isTemporary]
