"""The data tests of the staging views and marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame

from tablegate.operators.checks import (
    Check,
    KeyedCheck,
    calendar_failures,
    check_accepted_values,
    check_calendar_gaps,
    check_completeness,
    check_reconcile,
    check_relationships,
    check_unique,
    check_unique_combination,
    is_future,
    is_missing,
    is_outside,
    keyed_accepted,
    keyed_reconcile,
    keyed_relationship,
    keyed_unique,
)
from tablegate.plans.marts import DAILY_GRAIN, GRAIN

# Which columns are tested for what, per table.
UNIQUE = {
    "stg_weather__observations": ["observation_key"],
    "stg_weather__cities": ["city_id"],
    "dim_city": ["city_id"],
    "fct_weather_hourly": ["observation_key"],
}
NOT_NULL = {
    "stg_weather__observations": ["observation_key", "city_id", "observed_at_utc", "observation_date"],
    "stg_weather__cities": ["city_id", "city_name", "country_code"],
    "dim_city": ["city_id", "city_name", "observation_count"],
    "fct_weather_hourly": ["observation_key", "city_id", "observed_at_utc", "observation_date"],
    "agg_weather_daily": ["city_id", "observation_date", "hours_observed", "is_complete_day"],
}
PARENTS = {
    "stg_weather__observations": "stg_weather__cities",
    "fct_weather_hourly": "dim_city",
    "agg_weather_daily": "dim_city",
}
ACCEPTED: dict[str, tuple[str, Sequence[Any]]] = {
    "stg_weather__observations": ("contract_version", [1]),
    "stg_weather__cities": ("size_band", ["small", "medium", "large"]),
}
RANGES = {
    "stg_weather__observations": [
        ("temperature_c", -90, 60, "warn"),
        ("relative_humidity_pct", 0, 100, "warn"),
        ("precipitation_mm", 0, 500, "warn"),
    ],
    "fct_weather_hourly": [("hour_of_day_utc", 0, 23, "error")],
    "agg_weather_daily": [
        ("hours_observed", 1, 24, "error"),
        ("avg_temperature_c", -90, 60, "warn"),
    ],
}
GRAINS = {
    "stg_weather__observations": GRAIN,
    "fct_weather_hourly": GRAIN,
    "agg_weather_daily": DAILY_GRAIN,
}


def weather_checks(tables: dict[str, DataFrame], as_of: datetime) -> list[Check]:
    """All checks over the frames of :func:`tablegate.plans.marts.build_marts`."""
    checks = []
    for name, columns in UNIQUE.items():
        for column in columns:
            checks.append(
                Check(f"unique_{name}_{column}", failing=check_unique(tables[name], column))
            )
    for name, columns in NOT_NULL.items():
        for column in columns:
            checks.append(Check(f"not_null_{name}_{column}", tables[name], is_missing(column)))
    for name, parent in PARENTS.items():
        failing = check_relationships(tables[name], "city_id", tables[parent], "city_id")
        checks.append(Check(f"relationships_{name}_city_id", failing=failing))
    for name, (column, values) in ACCEPTED.items():
        failing = check_accepted_values(tables[name], column, values)
        checks.append(Check(f"accepted_values_{name}_{column}", failing=failing))
    for name, ranges in RANGES.items():
        for column, low, high, severity in ranges:
            outside = is_outside(column, low, high)
            checks.append(
                Check(f"accepted_range_{name}_{column}", tables[name], outside, severity=severity)
            )
    for name, grain in GRAINS.items():
        failing = check_unique_combination(tables[name], grain)
        checks.append(Check(f"unique_combination_{name}", failing=failing))

    hourly, daily = tables["fct_weather_hourly"], tables["agg_weather_daily"]
    return [
        *checks,
        Check("assert_daily_matches_hourly", failing=check_reconcile(hourly, daily, DAILY_GRAIN)),
        Check("assert_hourly_completeness", failing=check_completeness(daily), severity="warn"),
        Check(
            "assert_no_missing_days", failing=check_calendar_gaps(daily, "city_id"), severity="warn"
        ),
        Check("assert_no_future_observations", hourly, is_future("observed_at_utc", as_of)),
    ]


def weather_checks_together(tables: dict[str, DataFrame], as_of: datetime) -> list[Check | KeyedCheck]:
    """The same checks, written for :func:`tablegate.operators.checks.run_together`."""
    checks: list[Check | KeyedCheck] = []
    for name, columns in UNIQUE.items():
        for column in columns:
            checks.append(keyed_unique(f"unique_{name}_{column}", tables[name], [column], nulls=False))
    for name, columns in NOT_NULL.items():
        for column in columns:
            checks.append(Check(f"not_null_{name}_{column}", tables[name], is_missing(column)))
    for name, parent in PARENTS.items():
        checks.append(
            keyed_relationship(
                f"relationships_{name}_city_id", tables[name], "city_id", tables[parent], "city_id"
            )
        )
    for name, (column, values) in ACCEPTED.items():
        checks.append(keyed_accepted(f"accepted_values_{name}_{column}", tables[name], column, values))
    for name, ranges in RANGES.items():
        for column, low, high, severity in ranges:
            outside = is_outside(column, low, high)
            checks.append(
                Check(f"accepted_range_{name}_{column}", tables[name], outside, severity=severity)
            )
    for name, grain in GRAINS.items():
        checks.append(keyed_unique(f"unique_combination_{name}", tables[name], grain))
    hourly, daily = tables["fct_weather_hourly"], tables["agg_weather_daily"]
    incomplete, gaps = calendar_failures(daily, "city_id")
    return [
        *checks,
        keyed_reconcile("assert_daily_matches_hourly", hourly, daily, DAILY_GRAIN),
        Check("assert_hourly_completeness", failing=incomplete, severity="warn", counted=True),
        Check("assert_no_missing_days", failing=gaps, severity="warn", counted=True),
        Check("assert_no_future_observations", hourly, is_future("observed_at_utc", as_of)),
    ]
