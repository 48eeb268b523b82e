"""The daily flow: ingest, freshness, marts, data tests. It stops where it must."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.operators.checks import check_freshness, run_together
from tablegate.plans.data_tests import weather_checks_together
from tablegate.plans.ingest import Store, ingest_range, raw_schema
from tablegate.plans.marts import build_marts
from tablegate.sources.contract import Contract
from tablegate.sources.publish import read_table

STEPS = ("ingest", "freshness", "marts", "tests")
NOT_RUN = "not run"


def freshness(raw: DataFrame, contract: Contract, as_of: datetime) -> DataFrame:
    """(max_loaded_at, status) of the raw table, by the limits of its contract."""
    return check_freshness(
        raw,
        "_ingested_at_utc",
        as_of,
        warn_hours=contract.freshness_warn_hours,
        error_hours=contract.freshness_error_hours,
    )


def run_daily(
    spark: SparkSession,
    payloads: DataFrame,
    catalogue: DataFrame,
    contract: Contract,
    store: Store,
    run_id: str,
    start: date,
    end: date,
    as_of: datetime,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """(step, status, detail), one row per step.

    A raw table without a load within the contract's limit means that the ingestion did
    nothing: the marts are then left as they are, and the steps after it are not run.
    Failed units and failed tests are reported and stop nothing before them.
    """
    done: dict[str, tuple[str, str]] = {}

    def result() -> DataFrame:
        rows = [(step, *done.get(step, (NOT_RUN, ""))) for step in STEPS]
        return spark.createDataFrame(rows, "step string, status string, detail string")

    summary = ingest_range(
        spark, payloads, catalogue, contract, store, run_id, start, end, as_of.date(), **(options or {})
    ).first()
    failed = summary["partitions_failed"]
    done["ingest"] = (
        "warn" if failed else "pass",
        f"{summary['partitions_loaded']} loaded, {summary['partitions_skipped']} skipped, {failed} failed",
    )
    raw = read_table(spark, store.raw, raw_schema(contract))
    if raw is None:
        raw = spark.createDataFrame([], raw_schema(contract))
    newest = freshness(raw, contract, as_of).first()
    done["freshness"] = (newest["status"], str(newest["max_loaded_at"]))
    if newest["status"] == "error":
        return result()
    marts = build_marts(spark, raw, catalogue, store.marts, as_of=as_of)
    done["marts"] = ("pass", "")
    worst = run_together(weather_checks_together(marts, as_of)).groupBy("status").agg(
        F.count(F.lit(1)).alias("n")
    )
    found = {row["status"]: row["n"] for row in worst.collect()}
    status = next((s for s in ("error", "warn") if s in found), "pass")
    done["tests"] = (status, ", ".join(f"{found[s]} {s}" for s in ("pass", "warn", "error") if s in found))
    return result()
