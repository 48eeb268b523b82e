"""Windows of work: planned units, source lag, restatement."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.sources.publish import newest_partition

# Restated days, and the day before any data.
RESTATEMENT_DAYS = 7
EPOCH = date(1900, 1, 1)


def days_between(first: Column, last: Column) -> Column:
    """One row per day, both ends included; none when the range is inverted."""
    one_day = F.expr("interval 1 day")
    return F.explode(F.when(first <= last, F.sequence(first, last, one_day)))


def date_range(spark: SparkSession, start: date, end: date, name: str = "day") -> DataFrame:
    return spark.range(1).select(days_between(F.lit(start), F.lit(end)).alias(name))


def work_units(
    catalogue: DataFrame,
    start: date,
    end: date,
    key: str = "city_id",
    day: str = "observation_date",
    max_days: int | None = None,
) -> DataFrame:
    """Every (entity, day) of a range. Days are generated beside each entity,
    so there is no join and no shuffle. ``max_days`` refuses a longer plan."""
    if start > end:
        raise ValueError(f"inverted range: {start} to {end}")
    last_allowed = end if max_days is None else start + timedelta(days=max_days - 1)
    if end > last_allowed:
        raise ValueError(f"{start} to {end} is longer than max_days={max_days}")
    return catalogue.select(key, days_between(F.lit(start), F.lit(end)).alias(day))


def newest_day(as_of: date, lag_days: int) -> date:
    """Newest day the producer can be expected to have."""
    return as_of - timedelta(days=lag_days)


def target_day(interval_start: datetime, lag_days: int) -> date:
    """The day a scheduled run is responsible for."""
    return (interval_start - timedelta(days=lag_days)).date()


def clamp_range(start: date, end: date, as_of: date, lag_days: int) -> tuple[date, date] | None:
    """The range cut to the newest day; None when nothing is left to do.

    A range asked for the wrong way round is an error, not an empty one.
    """
    if start > end:
        raise ValueError(f"inverted range: {start} to {end}")
    end = min(end, newest_day(as_of, lag_days))
    return (start, end) if start <= end else None


def clamp_window(df: DataFrame, day: str, as_of: date, lag_days: int) -> DataFrame:
    return df.filter(F.col(day) <= F.date_sub(F.lit(as_of), lag_days))


def restatement_filter(
    rows: DataFrame, column: str, target: DataFrame, days: int = RESTATEMENT_DAYS
) -> DataFrame:
    """Rows from ``days`` before the newest day of ``target`` on, all if it is empty."""
    newest = target.agg(F.coalesce(F.max(column), F.lit(EPOCH)).alias("newest")).scalar()
    return rows.filter(F.col(column) >= F.date_sub(newest, days))


def restatement_cutoff(target: DataFrame | None, column: str, days: int = RESTATEMENT_DAYS) -> date:
    """First day to rebuild, as a literal: it prunes partitions while planning."""
    newest = None if target is None else target.agg(F.max(column)).first()[0]
    return (newest or EPOCH) - timedelta(days=days)


def stored_cutoff(
    spark: SparkSession, path: str, column: str, days: int = RESTATEMENT_DAYS
) -> date:
    """The same for a stored table partitioned by day: folder names give its newest day."""
    newest = newest_partition(spark, path, column)
    return (EPOCH if newest is None else date.fromisoformat(newest)) - timedelta(days=days)


def restated_days(rows: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Rows of an explicit range, for the rebuild after a backfill of old days."""
    return rows.filter(F.col(column).between(first, last))


def union_versions(versions: Sequence[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Union of contract versions, each with its own mapping to common columns."""
    parts = [
        df.select(*[value.alias(name) for name, value in mapping.items()]) for df, mapping in versions
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
