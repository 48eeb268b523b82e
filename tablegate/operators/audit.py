"""Load audit: one row per attempt of a unit, and what is read from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.time import utc_literal

# Columns of the audit table, status names, length of an error.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("dataset", T.StringType(), False),
        T.StructField("contract_version", T.LongType(), False),
        T.StructField("city_id", T.StringType(), False),
        T.StructField("observation_date", T.DateType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("source_payload_hash", T.StringType()),
        T.StructField("rows_fetched", T.LongType()),
        T.StructField("rows_accepted", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType()),
        T.StructField("started_at_utc", T.TimestampNTZType(), False),
        T.StructField("finished_at_utc", T.TimestampNTZType()),
    ]
)
LOADED, SKIPPED, FAILED = "loaded", "skipped_unchanged", "failed"
# When an attempt began, and the day that audit rows are stored under.
ATTEMPTED, DAY = "started_at_utc", "observation_date"


def audit_append(rows: DataFrame, path: str) -> None:
    """Append audit rows under the day of their unit; missing columns are null."""
    columns = []
    for field in AUDIT_SCHEMA:
        value = F.col(field.name) if field.name in rows.columns else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    stored = rows.select(*columns).hint("rebalance", DAY)
    stored.write.mode("append").partitionBy(DAY).parquet(path)


def load_state(
    audit: DataFrame,
    unit: Sequence[str] = ("city_id", "observation_date"),
    source_hash: str = "source_payload_hash",
) -> DataFrame:
    """The payload that each unit was last loaded from, one row per unit.

    An audit without a time of the attempt knows no order: then every payload that was
    ever loaded counts. Either way each map task sends a unit or a payload at most once.
    """
    loaded = audit.filter(F.col("status") == LOADED)
    if ATTEMPTED not in audit.columns:
        return loaded.select(*unit, source_hash).distinct()
    last = F.max_by(source_hash, F.struct(ATTEMPTED, source_hash))
    return loaded.groupBy(*unit).agg(last.alias(source_hash))


def loaded_before(
    units: DataFrame,
    audit: DataFrame,
    unit: Sequence[str] = ("city_id", "observation_date"),
    source_hash: str = "source_payload_hash",
) -> DataFrame:
    """Add ``already_loaded``: the unit's last successful load was of this payload.

    All units are looked up in one join. A payload that was loaded, then replaced by
    another one and now comes back is loaded again.
    """
    keys = [*unit, source_hash]
    seen = load_state(audit, unit, source_hash).withColumn("_seen", F.lit(True))
    return (
        units.join(seen, keys, "left")
        .withColumn("already_loaded", F.coalesce("_seen", F.lit(False)))
        .drop("_seen")
    )


def skip_unchanged(
    units: DataFrame,
    audit: DataFrame,
    unit: Sequence[str] = ("city_id", "observation_date"),
    source_hash: str = "source_payload_hash",
) -> DataFrame:
    """Units that still have to be loaded."""
    return units.join(load_state(audit, unit, source_hash), [*unit, source_hash], "left_anti")


def recent_attempts(audit: DataFrame, as_of: datetime, hours: int = 12) -> DataFrame:
    """Attempts of the last hours, newest first: the first look in an incident."""
    since = utc_literal(as_of) - F.expr(f"interval {hours} hours")
    return audit.filter(F.col("started_at_utc") >= since).orderBy(F.col("started_at_utc").desc())


def audit_by_day(audit: DataFrame, run_id: str) -> DataFrame:
    """What one run changed, per day."""
    return (
        audit.filter(F.col("run_id") == run_id)
        .groupBy("observation_date")
        .agg(
            F.count(F.lit(1)).alias("units"),
            F.sum("rows_inserted").alias("rows_inserted"),
            F.sum("rows_updated").alias("rows_updated"),
        )
    )


def run_summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals over per-unit results; a unit counts as loaded when it changed rows.

    A unit whose status is failed counts as failed, and every other one as skipped.
    """
    failed = F.coalesce(F.col("status") == FAILED, F.lit(False))
    changed = F.coalesce((F.col("rows_inserted") > 0) | (F.col("rows_updated") > 0), F.lit(False))
    changed = changed & ~failed

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("partitions_attempted"),
        F.count_if(changed).alias("partitions_loaded"),
        F.count_if(~changed & ~failed).alias("partitions_skipped"),
        F.count_if(failed).alias("partitions_failed"),
        total("rows_inserted"),
        total("rows_updated"),
        total("rows_rejected"),
    )


def cost_by_tag(
    queries: DataFrame, since: datetime, pattern: str = "scheduled__%"
) -> DataFrame:
    """Queries, seconds and credits per tag; ``pattern`` ignores case."""
    return (
        queries.filter(
            (F.col("start_time") >= utc_literal(since))
            & F.col("query_tag").ilike(pattern)
        )
        .groupBy("query_tag")
        .agg(
            F.count(F.lit(1)).alias("queries"),
            (F.sum("execution_time") / 1000).alias("seconds"),
            F.sum("credits").alias("credits"),
        )
        .orderBy(F.col("seconds").desc())
    )


def cost_by_day(metering: DataFrame, since: datetime, price: float = 3) -> DataFrame:
    """Credits and their price per warehouse and day."""
    return (
        metering.filter(F.col("start_time") >= utc_literal(since))
        .groupBy("warehouse_name", F.to_date("start_time").cast("timestamp_ntz").alias("day"))
        .agg(
            F.sum("credits_used").alias("credits"),
            (F.sum("credits_used") * price).alias("usd"),
        )
        .orderBy(F.col("day").desc(), "warehouse_name")
    )
