"""Ingestion and mart builds end to end, in a fresh store below the shared folder."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from tablegate.operators.checks import run_checks, run_together
from tablegate.plans.catalog import publish_catalog
from tablegate.plans.daily import run_daily
from tablegate.plans.data_tests import (
    ACCEPTED,
    GRAINS,
    NOT_NULL,
    PARENTS,
    RANGES,
    UNIQUE,
    weather_checks,
    weather_checks_together,
)
from tablegate.plans.ingest import Store, ingest_range, ingest_units, raw_schema
from tablegate.plans.marts import build_marts, rebuild_units
from tablegate.plans.registered import Query
from tablegate.plans.registered.inputs import (
    BY_USER,
    READINGS_SQL,
    by_user,
    event_types_as_cities,
    exact_avg_sql,
    exact_sum_sql,
    observations,
    table,
    weather_payloads,
)
from tablegate.session import scratch_path
from tablegate.sources.contract import Contract
from tablegate.sources.publish import read_table, replace_partitions

WEATHER = Contract.load("weather_observation", 1, Path(__file__).resolve().parents[3] / "contracts")
RATIO = 0.05
CUT = "2024-01-20 12:00:00"


def _store(spark):
    return Store(scratch_path(spark, "store"), buckets=2)


def _delivered(events, store, name):
    """The producer's payloads as a stored table, which is what a run reads."""
    path = f"{store.root}/payloads/{name.replace(' ', 'T').replace(':', '-')}"
    weather_payloads(events).write.mode("overwrite").parquet(path)
    return events.sparkSession.read.parquet(path)


def _run(spark, folder, store, until=None, run_id=None, started_at=datetime(2024, 2, 1), **options):
    events = by_user(table(spark, folder, "events"))
    catalogue = event_types_as_cities(events)
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return ingest_units(
        spark,
        _delivered(events, store, run_id or until or "all"),
        catalogue,
        WEATHER,
        store,
        run_id=run_id or until or "all",
        max_reject_ratio=RATIO,
        started_at=started_at,
        **options,
    )


def first_run(spark, folder):
    store = _store(spark)
    return _run(spark, folder, store).select(
        "city_id", "observation_date", "status", "rows_fetched", "rows_accepted", "rows_rejected",
        "rows_inserted",
    )


def second_run(spark, folder):
    """Loaded up to noon of the 20th, then again with the whole month."""
    store = _store(spark)
    _run(spark, folder, store, CUT)
    return _run(spark, folder, store).select(
        "city_id", "observation_date", "status", "rows_inserted", "rows_updated"
    )


def ranged(spark, folder):
    """A range whose end is cut by the source lag."""
    events = by_user(table(spark, folder, "events"))
    store = _store(spark)
    return ingest_range(
        spark,
        _delivered(events, store, "range"),
        event_types_as_cities(events),
        WEATHER,
        store,
        "range",
        date(2024, 1, 5),
        date(2024, 1, 25),
        as_of=date(2024, 1, 22),
        max_reject_ratio=RATIO,
    )


def _marts(spark, folder):
    store = _store(spark)
    catalogue = event_types_as_cities(by_user(table(spark, folder, "events")))
    schema = raw_schema(WEATHER)
    for until in (CUT, None):
        _run(spark, folder, store, until)
        raw = spark.read.schema(schema).parquet(store.raw)
        marts = build_marts(spark, raw, catalogue, store.marts, as_of=datetime(2024, 2, 1))
    return marts


_BUILT = {}


def _built(spark, folder):
    """The marts of a folder, built once in a session for the queries that only read them."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUILT:
        _BUILT[key] = _marts(spark, folder)
    return _BUILT[key]


def marts(spark, folder):
    daily = _marts(spark, folder)["agg_weather_daily"]
    return daily.select("city_id", "observation_date", "hours_observed", "max_wind_speed_kmh")


def mart_fact(spark, folder):
    """Every column of the fact but the hash of the JSON document."""
    return _built(spark, folder)["fct_weather_hourly"].drop("source_payload_hash")


def mart_daily(spark, folder):
    return _built(spark, folder)["agg_weather_daily"]


def mart_dimension(spark, folder):
    return _built(spark, folder)["dim_city"]


def data_tests(spark, folder):
    return run_checks(weather_checks(_built(spark, folder), as_of=datetime(2024, 1, 29)))


def data_tests_together(spark, folder):
    """The same from one aggregation over all marts."""
    return run_together(weather_checks_together(_built(spark, folder), as_of=datetime(2024, 1, 29)))


def full_refresh(spark, folder):
    """Loaded, and loaded again in full: all rows are updated though no payload changed."""
    store = _store(spark)
    _run(spark, folder, store)
    return _run(spark, folder, store, full_refresh=True).select(
        "city_id", "observation_date", "status", "rows_inserted", "rows_updated"
    )


def payload_returns(spark, folder):
    """Half of the 20th, the whole month, and the first payloads again: they load again."""
    store = _store(spark)
    _run(spark, folder, store, CUT)
    _run(spark, folder, store, started_at=datetime(2024, 2, 2))
    third = _run(spark, folder, store, CUT, run_id="again", started_at=datetime(2024, 2, 3))
    return third.select("city_id", "observation_date", "status", "rows_inserted", "rows_updated")


def latest_document(spark, folder):
    """Three deliveries of most units in one run; the last one loads, whole."""
    events = by_user(table(spark, folder, "events"))
    deliveries = []
    for number, share in enumerate((1.0, 0.5, 0.75)):
        changed = events.withColumn("value", F.col("value") * share)
        if number == 2:
            changed = changed.filter(F.col("user_id") % 3 != 0)
        deliveries.append(weather_payloads(changed).withColumn("delivered_at", F.lit(number)))
    store = _store(spark)
    path = f"{store.root}/payloads/all"
    deliveries[2].union(deliveries[0]).union(deliveries[1]).write.parquet(path)
    ingest_units(
        spark, spark.read.parquet(path), event_types_as_cities(events), WEATHER, store, "all",
        max_reject_ratio=RATIO, started_at=datetime(2024, 2, 1), delivered=["delivered_at"],
    )
    raw = read_table(spark, store.raw, raw_schema(WEATHER))
    return raw.select("city_id", "observed_at_utc", "wind_speed_10m_kmh", "_batch_id", "_contract_version")


def rebuilt_units(spark, folder):
    """Two backfilled days far apart, for two thirds of the users; the days between stay."""
    store, as_of = _store(spark), datetime(2024, 2, 1)
    events = table(spark, folder, "events")
    before = observations(events, "user_id")
    catalogue = event_types_as_cities(by_user(events))
    build_marts(spark, before, catalogue, store.marts, as_of=as_of)
    restated = before.withColumn("wind_speed_10m_kmh", F.col("wind_speed_10m_kmh") * 2)
    affected = before.select("city_id", "observation_date").filter(
        F.col("observation_date").isin(date(2024, 1, 3), date(2024, 1, 19)) & (F.col("city_id") % 3 != 0)
    )
    daily = rebuild_units(spark, restated, catalogue, store.marts, affected, as_of)["agg_weather_daily"]
    return daily.select("city_id", "observation_date", "hours_observed", "max_wind_speed_kmh")


def _daily_run(spark, folder, as_of):
    """One run of the daily flow over days 5 to 20, seen at ``as_of``."""
    store = _store(spark)
    events = by_user(table(spark, folder, "events"))
    steps = run_daily(
        spark, _delivered(events, store, "daily"), event_types_as_cities(events), WEATHER, store, "daily",
        date(2024, 1, 5), date(2024, 1, 20), as_of,
        {"max_reject_ratio": RATIO, "started_at": datetime(2024, 1, 22)},
    )
    built = read_table(spark, f"{store.marts}/agg_weather_daily")
    rows = 0 if built is None else built.count()
    return steps.withColumn("mart_rows", F.lit(rows).cast("long"))


def fresh_source(spark, folder):
    return _daily_run(spark, folder, datetime(2024, 1, 23))


def stale_source(spark, folder):
    """Three days without a load: the marts are not built."""
    return _daily_run(spark, folder, datetime(2024, 1, 25))


def catalog_tables(spark, folder):
    """Dimension, fact and staging view, read by name."""
    store = _store(spark)
    events = table(spark, folder, "events")
    raw, catalogue = observations(events, "user_id"), event_types_as_cities(by_user(events))
    replace_partitions(raw, store.raw, ["observation_date"])
    catalogue.write.parquet(f"{store.root}/cities")
    build_marts(spark, raw, catalogue, store.marts, as_of=datetime(2024, 2, 1))
    database = f"weather_{uuid.uuid4().hex[:8]}"
    publish_catalog(spark, database, store.raw, f"{store.root}/cities", store.marts)
    return spark.sql(f"""
        SELECT d.city_id, d.city_name, c.size_band, d.observation_count, count(*) AS staged_rows,
               count(f.observation_key) AS fact_rows, max(o.wind_speed_kmh) AS max_wind_speed_kmh
        FROM {database}.dim_city d
        JOIN {database}.stg_weather__cities c ON c.city_id = d.city_id
        JOIN {database}.stg_weather__observations o ON o.city_id = d.city_id
        LEFT JOIN {database}.fct_weather_hourly f ON f.observation_key = o.observation_key
        GROUP BY ALL
    """)


def _accepted_sql(name, source):
    """Readings, unit verdicts and accepted rows of one run."""
    return f"""
    {name}_readings AS ({READINGS_SQL.format(source=source)}),
    {name}_units AS (
        SELECT event_type, day, count(*) AS total, count(*) FILTER (WHERE value > 240) AS bad,
               CAST(count(*) FILTER (WHERE value > 240) AS DOUBLE) / count(*) <= {RATIO} AS passed
        FROM {name}_readings GROUP BY ALL),
    {name}_rows AS (
        SELECT r.* FROM {name}_readings r JOIN {name}_units u
        ON r.event_type = u.event_type AND r.day = u.day WHERE u.passed AND r.value <= 240)
    """


_EARLY = f"(SELECT * FROM {BY_USER} WHERE ts < TIMESTAMP '{CUT}')"

# A quarter of a two-digit value, never below zero, in whole numbers.
_TEN_THOUSANDTHS = "CAST(round(temperature_c * 10000) AS BIGINT)"

# The marts after the early and the whole run, all columns.
_MARTS_SQL = f"""
    WITH {_accepted_sql("a", _EARLY)}, {_accepted_sql("b", BY_USER)},
    raw AS (SELECT event_type, day, hour, value, k FROM b_rows
            UNION ALL
            SELECT event_type, day, hour, value, k FROM a_rows a WHERE NOT EXISTS (
                SELECT 1 FROM b_rows b WHERE a.event_type = b.event_type AND a.hour = b.hour)),
    cities AS (SELECT DISTINCT event_type AS city_id, event_type AS city_name,
                      upper(event_type[1:2]) AS country_code, CAST(0 AS DOUBLE) AS latitude,
                      CAST(0 AS DOUBLE) AS longitude, 'UTC' AS timezone_name, CAST(0 AS BIGINT) AS population,
                      'small' AS size_band
               FROM {BY_USER}),
    staged AS (
        SELECT md5(event_type || '-' || strftime(hour, '%Y-%m-%d %H:%M:%S') || '.000000') AS observation_key,
               event_type AS city_id, hour AS observed_at_utc, day AS observation_date,
               value / 4 AS temperature_c, CAST(k AS DOUBLE) AS relative_humidity_pct,
               greatest(value - 50, 0.0) AS precipitation_mm, value AS wind_speed_kmh,
               CAST(k AS BIGINT) AS weather_code,
               substr(sha256(event_type || '|' || strftime(day, '%Y-%m-%d') || '|v1'), 1, 32) AS batch_id,
               CAST(1 AS BIGINT) AS contract_version, TIMESTAMP '2024-02-01' AS ingested_at_utc
        FROM raw),
    hourly AS (
        SELECT observation_key, s.city_id, city_name, country_code, observed_at_utc, observation_date,
               observed_at_utc AS observed_hour_utc, CAST(hour(observed_at_utc) AS INTEGER) AS hour_of_day_utc,
               CAST(isodow(observation_date) AS INTEGER) AS day_of_week_iso, temperature_c,
               relative_humidity_pct, precipitation_mm, wind_speed_kmh, weather_code,
               precipitation_mm > 0 AS is_wet_hour, temperature_c < 0 AS is_freezing_hour, batch_id,
               contract_version, ingested_at_utc, TIMESTAMP '2024-02-01' AS dbt_updated_at
        FROM staged s JOIN cities c ON s.city_id = c.city_id),
    daily AS (
        SELECT city_id, observation_date, any_value(city_name) AS city_name,
               any_value(country_code) AS country_code, count(*) AS hours_observed,
               count(*) = 24 AS is_complete_day,
               CAST((2 * sum({_TEN_THOUSANDTHS}) + 100 * count(*)) // (200 * count(*)) AS DOUBLE) / 100
                   AS avg_temperature_c,
               CAST((min({_TEN_THOUSANDTHS}) + 50) // 100 AS DOUBLE) / 100 AS min_temperature_c,
               CAST((max({_TEN_THOUSANDTHS}) + 50) // 100 AS DOUBLE) / 100 AS max_temperature_c,
               {exact_avg_sql("relative_humidity_pct")} AS avg_relative_humidity_pct,
               {exact_sum_sql("precipitation_mm")} AS total_precipitation_mm,
               round(max(wind_speed_kmh), 2) AS max_wind_speed_kmh,
               count(*) FILTER (WHERE is_wet_hour) AS wet_hours,
               count(*) FILTER (WHERE is_freezing_hour) AS freezing_hours,
               count(*) FILTER (WHERE temperature_c IS NULL) AS hours_missing_temperature,
               max(ingested_at_utc) AS last_ingested_at_utc, TIMESTAMP '2024-02-01' AS dbt_updated_at
        FROM hourly GROUP BY city_id, observation_date),
    dimension AS (
        SELECT c.*, first_observation_date, last_observation_date,
               coalesce(observation_count, 0) AS observation_count,
               first_observation_date IS NOT NULL AS has_observations
        FROM cities c LEFT JOIN (
            SELECT city_id, min(observation_date) AS first_observation_date,
                   max(observation_date) AS last_observation_date, count(*) AS observation_count
            FROM staged GROUP BY city_id) USING (city_id))
"""


def _tests_sql():
    """Each data test's failing rows, counted from the marts in SQL."""
    names = {
        "stg_weather__observations": "staged", "stg_weather__cities": "cities", "dim_city": "dimension",
        "fct_weather_hourly": "hourly", "agg_weather_daily": "daily",
    }
    found = []

    def add(check, severity, count):
        found.append(f"SELECT '{check}' AS \"check\", '{severity}' AS severity, ({count}) AS failures")

    def repeated(table, columns, where="true"):
        listed = ", ".join(columns)
        return (
            f"SELECT count(*) FROM (SELECT {listed} FROM {names[table]} WHERE {where} "
            f"GROUP BY {listed} HAVING count(*) > 1)"
        )

    for table, columns in UNIQUE.items():
        for c in columns:
            add(f"unique_{table}_{c}", "error", repeated(table, [c], f"{c} IS NOT NULL"))
    for table, columns in NOT_NULL.items():
        for c in columns:
            add(f"not_null_{table}_{c}", "error", f"SELECT count(*) FROM {names[table]} WHERE {c} IS NULL")
    for table, parent in PARENTS.items():
        orphans = f"city_id IS NOT NULL AND city_id NOT IN (SELECT city_id FROM {names[parent]})"
        add(f"relationships_{table}_city_id", "error", f"SELECT count(*) FROM {names[table]} WHERE {orphans}")
    for table, (c, values) in ACCEPTED.items():
        listed = ", ".join(map(repr, values))
        other = f"SELECT count(DISTINCT {c}) FROM {names[table]} WHERE {c} NOT IN ({listed})"
        add(f"accepted_values_{table}_{c}", "error", other)
    for table, ranges in RANGES.items():
        for c, low, high, severity in ranges:
            outside = f"SELECT count(*) FROM {names[table]} WHERE {c} NOT BETWEEN {low} AND {high}"
            add(f"accepted_range_{table}_{c}", severity, outside)
    for table, grain in GRAINS.items():
        add(f"unique_combination_{table}", "error", repeated(table, grain))
    add("assert_daily_matches_hourly", "error", """
        SELECT count(*) FROM daily d FULL JOIN (
            SELECT city_id, observation_date, count(*) AS n FROM hourly GROUP BY ALL) h
        ON d.city_id = h.city_id AND d.observation_date = h.observation_date
        WHERE d.hours_observed IS DISTINCT FROM h.n""")  # fmt: skip
    add("assert_hourly_completeness", "warn", """
        SELECT count(*) FROM daily WHERE hours_observed <> 24
        AND observation_date < (SELECT max(observation_date) - 1 FROM daily)""")  # fmt: skip
    add("assert_no_missing_days", "warn", """
        SELECT coalesce(sum(days), 0) FROM (
            SELECT max(observation_date) - min(observation_date) + 1 - count(DISTINCT observation_date) AS days
            FROM daily GROUP BY city_id)""")  # fmt: skip
    add("assert_no_future_observations", "error", """
        SELECT count(*) FROM hourly WHERE observed_at_utc > TIMESTAMP '2024-01-29 01:00:00'""")  # fmt: skip
    union = " UNION ALL ".join(found)
    return f"""{_MARTS_SQL}
        SELECT "check", severity, CAST(failures AS BIGINT) AS failures,
               CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status
        FROM ({union})"""


_TESTS_SQL = _tests_sql()

# The daily flow over days 5 to 20: units, and what the steps report.
_DAILY_SQL = f"""
    WITH {_accepted_sql("b", BY_USER)},
    plan AS (SELECT DISTINCT event_type, CAST(d AS DATE) AS day
             FROM {BY_USER}, generate_series(DATE '2024-01-05', DATE '2024-01-20', INTERVAL 1 DAY) g(d)),
    units AS (SELECT coalesce(u.passed, false) AS passed, coalesce(u.passed, false) AND u.total > u.bad AS loaded
              FROM plan p LEFT JOIN b_units u ON p.event_type = u.event_type AND p.day = u.day),
    counts AS (SELECT count(*) FILTER (WHERE loaded) AS loaded, count(*) FILTER (WHERE NOT loaded AND passed) AS skipped,
                      count(*) FILTER (WHERE NOT passed) AS failed FROM units),
    ingest AS (SELECT 'ingest' AS step, CASE WHEN failed > 0 THEN 'warn' ELSE 'pass' END AS status,
                      loaded || ' loaded, ' || skipped || ' skipped, ' || failed || ' failed' AS detail FROM counts),
    kept AS (SELECT r.event_type, r.day, count(*) AS hours FROM b_rows r
             WHERE r.day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY ALL)
"""

QUERIES = {
    "ingest_units": Query(
        first_run,
        f"""
        WITH {_accepted_sql("b", BY_USER)}
        SELECT event_type AS city_id, day AS observation_date,
               CASE WHEN passed THEN 'loaded' ELSE 'failed' END AS status, total AS rows_fetched,
               CASE WHEN passed THEN total - bad ELSE 0 END AS rows_accepted, bad AS rows_rejected,
               CASE WHEN passed THEN total - bad ELSE 0 END AS rows_inserted
        FROM b_units
        """,
    ),
    "ingest_rerun": Query(
        second_run,
        f"""
        WITH {_accepted_sql("a", _EARLY)}, {_accepted_sql("b", BY_USER)},
        state AS (
            SELECT b.event_type, b.day, b.passed, coalesce(a.passed, false) AND NOT EXISTS (
                       SELECT 1 FROM {BY_USER} e WHERE e.event_type = b.event_type
                       AND CAST(e.ts AS DATE) = b.day AND e.ts >= TIMESTAMP '{CUT}') AS seen
            FROM b_units b LEFT JOIN a_units a ON a.event_type = b.event_type AND a.day = b.day),
        changes AS (
            SELECT b.event_type, b.day, count(*) FILTER (WHERE a.hour IS NULL) AS inserted,
                   count(*) FILTER (WHERE a.hour IS NOT NULL) AS updated
            FROM b_rows b LEFT JOIN a_rows a ON a.event_type = b.event_type AND a.hour = b.hour
            GROUP BY ALL)
        SELECT s.event_type AS city_id, s.day AS observation_date,
               CASE WHEN seen THEN 'skipped_unchanged' WHEN passed THEN 'loaded'
                    ELSE 'failed' END AS status,
               CASE WHEN seen THEN 0 ELSE coalesce(inserted, 0) END AS rows_inserted,
               CASE WHEN seen THEN 0 ELSE coalesce(updated, 0) END AS rows_updated
        FROM state s LEFT JOIN changes c ON s.event_type = c.event_type AND s.day = c.day
        """,
    ),
    "ingest_range": Query(
        ranged,
        f"""
        WITH {_accepted_sql("b", BY_USER)},
        plan AS (SELECT DISTINCT event_type, CAST(d AS DATE) AS day
                 FROM {BY_USER}, generate_series(DATE '2024-01-05', DATE '2024-01-20', INTERVAL 1 DAY) g(d)),
        units AS (SELECT p.*, coalesce(u.total, 0) AS total, coalesce(u.bad, 0) AS bad,
                         coalesce(u.passed, false) AS passed,
                         coalesce(u.passed, false) AND u.total > u.bad AS loaded
                  FROM plan p LEFT JOIN b_units u ON p.event_type = u.event_type AND p.day = u.day)
        SELECT count(*) AS partitions_attempted,
               count(*) FILTER (WHERE loaded) AS partitions_loaded,
               count(*) FILTER (WHERE NOT loaded AND passed) AS partitions_skipped,
               count(*) FILTER (WHERE NOT passed) AS partitions_failed,
               CAST(coalesce(sum(total - bad) FILTER (WHERE loaded), 0) AS BIGINT) AS rows_inserted,
               CAST(0 AS BIGINT) AS rows_updated, CAST(sum(bad) AS BIGINT) AS rows_rejected
        FROM units
        """,
    ),
    "build_marts": Query(
        marts,
        f"""
        WITH {_accepted_sql("a", _EARLY)}, {_accepted_sql("b", BY_USER)},
        raw AS (SELECT event_type, day, hour, value FROM b_rows
                UNION ALL
                SELECT event_type, day, hour, value FROM a_rows a WHERE NOT EXISTS (
                    SELECT 1 FROM b_rows b WHERE a.event_type = b.event_type AND a.hour = b.hour))
        SELECT event_type AS city_id, day AS observation_date, count(*) AS hours_observed,
               round(max(value), 2) AS max_wind_speed_kmh
        FROM raw GROUP BY ALL
        """,
    ),
    "mart_fact": Query(mart_fact, _MARTS_SQL + "SELECT * FROM hourly"),
    "mart_daily": Query(mart_daily, _MARTS_SQL + "SELECT * FROM daily"),
    "mart_dimension": Query(mart_dimension, _MARTS_SQL + "SELECT * FROM dimension"),
    "data_tests": Query(data_tests, _TESTS_SQL),
    "data_tests_together": Query(data_tests_together, _TESTS_SQL),
    "full_refresh": Query(
        full_refresh,
        f"""
        WITH {_accepted_sql("b", BY_USER)}
        SELECT event_type AS city_id, day AS observation_date,
               CASE WHEN passed THEN 'loaded' ELSE 'failed' END AS status, CAST(0 AS BIGINT) AS rows_inserted,
               CASE WHEN passed THEN total - bad ELSE 0 END AS rows_updated
        FROM b_units
        """,
    ),
    "payload_returns": Query(
        payload_returns,
        f"""
        WITH {_accepted_sql("a", _EARLY)}, {_accepted_sql("b", BY_USER)},
        later AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM {BY_USER} WHERE ts >= TIMESTAMP '{CUT}'),
        state AS (
            SELECT a.event_type, a.day, a.passed, a.total - a.bad AS rows,
                   a.passed AND NOT (l.day IS NOT NULL AND b.passed) AS seen
            FROM a_units a JOIN b_units b ON a.event_type = b.event_type AND a.day = b.day
            LEFT JOIN later l ON l.event_type = a.event_type AND l.day = a.day)
        SELECT event_type AS city_id, day AS observation_date,
               CASE WHEN NOT passed THEN 'failed' WHEN seen THEN 'skipped_unchanged' ELSE 'loaded' END AS status,
               CAST(0 AS BIGINT) AS rows_inserted,
               CASE WHEN passed AND NOT seen THEN rows ELSE 0 END AS rows_updated
        FROM state
        """,
    ),
    "latest_document": Query(
        latest_document,
        f"""
        WITH shares AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN 0.5 ELSE 0.75 END AS share FROM {BY_USER}),
        last AS (SELECT * REPLACE (value * share AS value) FROM shares),
        {_accepted_sql("b", "last")}
        SELECT event_type AS city_id, hour AS observed_at_utc, value AS wind_speed_10m_kmh,
               substr(sha256(event_type || '|' || strftime(day, '%Y-%m-%d') || '|v1'), 1, 32) AS _batch_id,
               CAST(1 AS INTEGER) AS _contract_version
        FROM b_rows
        """,
    ),
    "rebuild_units": Query(
        rebuilt_units,
        f"""
        SELECT event_type AS city_id, day AS observation_date, count(*) AS hours_observed,
               round(max(CASE WHEN day IN (DATE '2024-01-03', DATE '2024-01-19') AND CAST(event_type AS BIGINT) % 3 <> 0
                              THEN value * 2 ELSE value END), 2) AS max_wind_speed_kmh
        FROM ({READINGS_SQL.format(source=BY_USER)}) GROUP BY ALL
        """,
    ),
    "fresh_source": Query(
        fresh_source,
        _DAILY_SQL
        + """,
        tests AS (
            SELECT (SELECT count(*) FROM kept WHERE hours <> 24 AND day < (SELECT max(day) - 1 FROM kept)) AS short,
                   (SELECT sum(gap) FROM (SELECT max(day) - min(day) + 1 - count(*) AS gap FROM kept GROUP BY event_type)) AS gaps)
        SELECT *, (SELECT count(*) FROM kept) AS mart_rows FROM (
            SELECT * FROM ingest UNION ALL SELECT 'freshness', 'pass', '2024-01-22 00:00:00'
            UNION ALL SELECT 'marts', 'pass', ''
            UNION ALL SELECT 'tests', CASE WHEN short + gaps > 0 THEN 'warn' ELSE 'pass' END,
                             40 - CAST(short > 0 AS INT) - CAST(gaps > 0 AS INT) || ' pass'
                             || CASE WHEN short + gaps > 0
                                     THEN ', ' || CAST(short > 0 AS INT) + CAST(gaps > 0 AS INT) || ' warn' ELSE '' END
                      FROM tests)
        """,
    ),
    "stale_source": Query(
        stale_source,
        _DAILY_SQL
        + """
        SELECT *, CAST(0 AS BIGINT) AS mart_rows FROM (
            SELECT * FROM ingest UNION ALL SELECT 'freshness', 'error', '2024-01-22 00:00:00'
            UNION ALL SELECT 'marts', 'not run', '' UNION ALL SELECT 'tests', 'not run', '')
        """,
    ),
    "catalog_tables": Query(
        catalog_tables,
        f"""
        SELECT event_type AS city_id, event_type AS city_name, 'small' AS size_band, count(*) AS observation_count,
               count(*) AS staged_rows, count(*) AS fact_rows, max(value) AS max_wind_speed_kmh
        FROM ({READINGS_SQL.format(source=BY_USER)}) GROUP BY event_type
        """,
    ),
}
