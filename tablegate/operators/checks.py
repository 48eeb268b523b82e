"""Data checks. Each gives its failing rows; none means the check passed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.functions.time import utc_literal
from tablegate.session import materialize

# Freshness limits in hours, readings of a complete day, days
# before the newest one that may still fill up, tolerated clock skew in hours.
WARN_HOURS = 30
ERROR_HOURS = 48
HOURS_PER_DAY = 24
FILLING_DAYS = 1
SKEW_HOURS = 1


# Row checks: a failing row is one for which the condition is true.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_outside(
    column: str, low: Any = None, high: Any = None, inclusive: bool = True
) -> Column:
    """Outside the range; a null value is not outside."""
    value = F.col(column)
    inside = []
    if low is not None:
        inside.append(value >= low if inclusive else value > low)
    if high is not None:
        inside.append(value <= high if inclusive else value < high)
    if not inside:
        raise ValueError("give a lower or an upper bound")
    return F.coalesce(reduce(lambda a, b: a | b, [~c for c in inside]), F.lit(False))


def is_future(column: str, as_of: datetime, hours: int = SKEW_HOURS) -> Column:
    limit = utc_literal(as_of) + F.expr(f"interval {hours} hours")
    return F.col(column) > limit


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def check_accepted_range(
    df: DataFrame, column: str, low: Any = None, high: Any = None, inclusive: bool = True
) -> DataFrame:
    return df.filter(is_outside(column, low, high, inclusive))


def check_no_future(
    df: DataFrame, column: str, as_of: datetime, hours: int = SKEW_HOURS
) -> DataFrame:
    return df.filter(is_future(column, as_of, hours))


# Table checks.


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Other values than the accepted ones, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose key is not in the parent; null keys do not count."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def check_freshness(
    df: DataFrame,
    loaded_at: str,
    as_of: datetime,
    by: Sequence[str] = (),
    warn_hours: int = WARN_HOURS,
    error_hours: int = ERROR_HOURS,
) -> DataFrame:
    """Newest load per group with status pass, warn or error; no load is an error."""
    now = utc_literal(as_of)
    newest = F.col("max_loaded_at")
    status = (
        F.when(newest.isNull() | (newest < now - F.expr(f"interval {error_hours} hours")), "error")
        .when(newest < now - F.expr(f"interval {warn_hours} hours"), "warn")
        .otherwise("pass")
    )
    return (
        df.groupBy(*by)
        .agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
        .withColumn("status", status)
    )


def check_reconcile(
    fact: DataFrame, aggregate: DataFrame, keys: Sequence[str], reported: str = "hours_observed"
) -> DataFrame:
    """Groups whose row count in the fact differs from what the aggregate reports.

    Groups missing on either side differ too. The fact is counted before it is
    joined, so no hot group is shuffled as rows.
    """
    keys = list(keys)
    counted = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("fact_rows"))
    stated = aggregate.select(*keys, reported)
    both = stated.join(counted, keys, "left").filter(
        ~F.col("fact_rows").eqNullSafe(F.col(reported))
    )
    only_fact = counted.join(stated.select(*keys).distinct(), keys, "left_anti").withColumn(
        reported, F.lit(None).cast(stated.schema[reported].dataType)
    )
    return both.select(*keys, "fact_rows", reported).unionByName(only_fact)


def check_completeness(
    daily: DataFrame,
    day: str = "observation_date",
    observed: str = "hours_observed",
    expected: int = HOURS_PER_DAY,
    filling_days: int = FILLING_DAYS,
) -> DataFrame:
    """Finished days with another number of readings than expected."""
    newest = daily.agg(F.max(day).alias("newest")).scalar()
    return daily.filter(
        (F.col(day) < F.date_sub(newest, filling_days)) & (F.col(observed) != expected)
    ).withColumn("missing_hours", F.lit(expected) - F.col(observed))


def check_calendar_gaps(df: DataFrame, entity: str, day: str = "observation_date") -> DataFrame:
    """Days without any row between the first and the last day of each entity.

    Rows become distinct (entity, day) pairs first; only the holes between
    neighbouring days are then generated, so there is no calendar to join.
    """
    days = df.select(entity, day).filter(F.col(entity).isNotNull() & F.col(day).isNotNull())
    order = Window.partitionBy(entity).orderBy(day)
    previous = F.lag(day).over(order)
    hole = (
        days.distinct()
        .withColumn("_previous", previous)
        .filter(F.datediff(F.col(day), F.col("_previous")) > 1)
    )
    first, last = F.date_add("_previous", 1), F.date_sub(F.col(day), 1)
    return hole.select(entity, F.explode(F.sequence(first, last)).alias("missing_date"))


def check_range_completeness(
    daily: DataFrame,
    first: date,
    last: date,
    entity: str,
    expected_entities: int,
    expected_hours: int,
    day: str = "observation_date",
    observed: str = "hours_observed",
) -> DataFrame:
    """Days of a range with too few entities or too few readings in total."""
    return (
        daily.filter(F.col(day).between(first, last))
        .groupBy(day)
        .agg(F.count_distinct(entity).alias("entities"), F.sum(observed).alias("hours"))
        .filter((F.col("entities") < expected_entities) | (F.col("hours") < expected_hours))
    )


# Running many checks.


@dataclass(frozen=True)
class Check:
    """A named check: either a condition on the rows of ``table``, or a frame of
    failing rows, which with ``counted`` is one row of their number, ``failures``.
    ``severity`` is error or warn."""

    name: str
    table: DataFrame | None = None
    fails_if: Column | None = None
    failing: DataFrame | None = None
    severity: str = "error"
    counted: bool = False

    def __post_init__(self) -> None:
        if (self.failing is None) == (self.table is None or self.fails_if is None):
            raise ValueError(f"check {self.name}: give a table and a condition, or failing rows")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"check {self.name}: severity is error or warn")

    def rows(self) -> DataFrame:
        return self.failing if self.failing is not None else self.table.filter(self.fails_if)


@dataclass(frozen=True)
class Part:
    """What rows of one table bring to the groups of a check.

    A row for which ``only`` is true joins the group of its ``keys`` (nulls are values)
    with ``own`` and ``other`` added up there.
    """

    table: DataFrame
    keys: Sequence[Column]
    own: Column | None = None
    other: Column | None = None
    only: Column | None = None


@dataclass(frozen=True)
class KeyedCheck:
    """A check on groups of rows. ``failures`` is the number that a group fails with, over
    its sums ``own`` and ``other``, which are null where no row brought a value."""

    name: str
    parts: Sequence[Part]
    failures: Column
    severity: str = "error"


def keyed_unique(name: str, df: DataFrame, columns: Sequence[str], nulls: bool = True) -> KeyedCheck:
    """As :func:`check_unique_combination`, or without ``nulls`` as :func:`check_unique`."""
    only = None
    if not nulls:
        only = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = F.when(F.col("own") > 1, 1).otherwise(0)
    return KeyedCheck(name, [Part(df, [F.col(c) for c in columns], own=F.lit(1), only=only)], repeated)


def keyed_accepted(name: str, df: DataFrame, column: str, values: Sequence[Any]) -> KeyedCheck:
    """As :func:`check_accepted_values`: each other value fails once."""
    other = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return KeyedCheck(name, [Part(df, [F.col(column)], own=F.lit(1), only=other)], F.lit(1))


def keyed_relationship(
    name: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> KeyedCheck:
    """As :func:`check_relationships`: each child row without a parent fails."""
    parts = [
        Part(child, [F.col(column)], own=F.lit(1), only=F.col(column).isNotNull()),
        Part(parent, [F.col(parent_column)], other=F.lit(1)),
    ]
    orphans = F.when(F.col("other").isNull(), F.coalesce("own", F.lit(0))).otherwise(0)
    return KeyedCheck(name, parts, orphans)


def keyed_reconcile(
    name: str, fact: DataFrame, aggregate: DataFrame, keys: Sequence[str], reported: str = "hours_observed"
) -> KeyedCheck:
    """As :func:`check_reconcile`, for an aggregate with one row per key."""
    named = [F.col(c) for c in keys]
    parts = [
        Part(fact, named, own=F.lit(1)),
        Part(aggregate, named, other=F.col(reported)),
    ]
    return KeyedCheck(name, parts, F.when(F.col("own").eqNullSafe(F.col("other")), 0).otherwise(1))


def run_together(checks: Sequence[Check | KeyedCheck]) -> DataFrame:
    """(check, severity, failures, status) as :func:`run_checks`, with few scans.

    Every row of a table becomes one small row for each group it counts in and for each
    condition it fails, all tables' rows meet in one aggregation with partial sums before
    its shuffle, and the groups' failures are added up. So all conditions, uniqueness,
    accepted values, relationships and reconciliations together scan each table once.
    """
    simple = [c for c in checks if isinstance(c, Check) and c.failing is not None]
    joint = [c for c in checks if isinstance(c, KeyedCheck) or c.failing is None]
    bring: dict[int, tuple[DataFrame, list[Column]]] = {}

    def add(number: int, part: Part, key: Column) -> None:
        none = F.lit(None).cast("long")
        row = F.struct(
            F.lit(number).alias("check_no"),
            key.alias("key"),
            (none if part.own is None else part.own.cast("long")).alias("own"),
            (none if part.other is None else part.other.cast("long")).alias("other"),
        )
        kept = row if part.only is None else F.when(F.coalesce(part.only, F.lit(False)), row)
        bring.setdefault(id(part.table), (part.table, []))[1].append(kept)

    for number, check in enumerate(joint):
        if isinstance(check, Check):
            part = Part(check.table, [], own=F.lit(1), only=check.fails_if)
            add(number, part, F.lit("[]"))
            continue
        for part in check.parts:
            texts = [F.coalesce(F.to_json(F.array(key.cast("string"))), F.lit("")) for key in part.keys]
            add(number, part, F.concat(*texts))

    def rows(table: DataFrame, columns: list[Column]) -> DataFrame:
        return table.select(F.inline(F.filter(F.array(*columns), lambda row: row.isNotNull())))

    parts = []
    if joint:
        every = reduce(DataFrame.unionAll, [rows(*found) for found in bring.values()])
        groups = every.groupBy("check_no", "key").agg(F.sum("own").alias("own"), F.sum("other").alias("other"))
        failures = F.lit(0).cast("long")
        for number, check in enumerate(joint):
            value = F.col("own") if isinstance(check, Check) else check.failures
            failures = F.when(F.col("check_no") == number, value.cast("long")).otherwise(failures)
        counted = groups.groupBy("check_no").agg(F.sum(failures).alias("found"))
        listed = F.array(*[
            F.struct(F.lit(i).alias("number"), F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"))
            for i, c in enumerate(joint)
        ])
        names = every.sparkSession.range(1).select(F.inline(listed))
        parts.append(
            names.join(F.broadcast(counted), F.col("number") == F.col("check_no"), "left").select(
                "check", "severity", F.coalesce("found", F.lit(0).cast("long")).alias("failures")
            )
        )
    for check in simple:
        number = F.sum("failures") if check.counted else F.count(F.lit(1))
        parts.append(
            check.failing.agg(number.alias("failures")).select(
                F.lit(check.name).alias("check"), F.lit(check.severity).alias("severity"), "failures"
            )
        )
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    )


def calendar_failures(
    daily: DataFrame,
    entity: str,
    day: str = "observation_date",
    observed: str = "hours_observed",
    expected: int = HOURS_PER_DAY,
    filling_days: int = FILLING_DAYS,
) -> tuple[DataFrame, DataFrame]:
    """How many rows :func:`check_completeness` and :func:`check_calendar_gaps` would give.

    As one-column frames ``failures`` over one materialised small table, which holds a row
    for each entity and a row for each day. So the aggregate is scanned once for both.
    """
    keys = [F.col(entity), F.col(day)]
    known = keys[0].isNotNull() & keys[1].isNotNull()
    short = F.count_if(F.col(observed) != expected).alias("short")
    days = daily.groupBy(*keys).agg(short)
    rows = F.array(
        F.when(known, F.struct(keys[0].cast("string").alias("of"), F.lit(1).alias("days"), F.lit(0).cast("long").alias("short"))),
        F.struct(F.lit(None).cast("string").alias("of"), F.lit(0).alias("days"), F.col("short")),
    )
    spread = days.select(F.col(day).alias("day"), F.inline(F.filter(rows, lambda row: row.isNotNull())))
    per_day = F.when(F.col("of").isNull(), F.col("day"))
    small = materialize(
        spread.groupBy("of", per_day.alias("of_day")).agg(
            F.min("day").alias("first"), F.max("day").alias("last"),
            F.sum("days").alias("days"), F.sum("short").alias("short"),
        )
    )
    finished = small.filter(F.col("of").isNull())
    newest = finished.agg(F.max("of_day").alias("newest")).scalar()
    incomplete = finished.filter(F.col("of_day") < F.date_sub(newest, filling_days))
    missing = F.datediff("last", "first") + 1 - F.col("days")
    zero = F.lit(0).cast("long")
    return (
        incomplete.agg(F.coalesce(F.sum("short"), zero).alias("failures")),
        small.filter(F.col("of").isNotNull()).agg(F.coalesce(F.sum(missing), zero).alias("failures")),
    )


def run_checks(checks: Sequence[Check], store_to: str | None = None) -> DataFrame:
    """(check, severity, failures, status) with one row per check.

    All row conditions on one table are counted in a single scan. With
    ``store_to`` the failing rows of each check are first written below that
    path as ``<store_to>/<check>``, and counted from there.
    """
    if not checks:
        raise ValueError("no checks given")
    if store_to is not None:
        stored = []
        for check in checks:
            path = f"{store_to.rstrip('/')}/{check.name}"
            rows = check.rows()
            rows.write.mode("overwrite").parquet(path)
            kept = rows.sparkSession.read.schema(rows.schema).parquet(path)
            stored.append(Check(check.name, failing=kept, severity=check.severity))
        checks = stored

    by_table: dict[int, list[Check]] = {}
    parts = []
    for check in checks:
        if check.failing is None:
            by_table.setdefault(id(check.table), []).append(check)
        else:
            parts.append(
                check.failing.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(check.name).alias("check"),
                    F.lit(check.severity).alias("severity"),
                    "failures",
                )
            )
    for group in by_table.values():
        counted = group[0].table.agg(
            *[
                F.count_if(F.coalesce(c.fails_if, F.lit(False))).alias(f"_{i}")
                for i, c in enumerate(group)
            ]
        )
        rows = [
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.severity).alias("severity"),
                F.col(f"_{i}").alias("failures"),
            )
            for i, c in enumerate(group)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    result = reduce(DataFrame.unionByName, parts)
    return result.withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    )
