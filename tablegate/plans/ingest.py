"""Ingestion of many units at once: parse, skip, gate, land, merge, audit.

The unit of work is one (city, day). All units of a run go through each step
together; a unit that fails is recorded and does not stop the others.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.identity import batch_id, document_hash
from tablegate.functions.time import utc_literal
from tablegate.operators.audit import (
    AUDIT_SCHEMA,
    FAILED,
    LOADED,
    SKIPPED,
    audit_append,
    loaded_before,
    run_summary,
)
from tablegate.operators.incremental import clamp_range, work_units
from tablegate.operators.joins import anti_join, semi_join, small
from tablegate.operators.merge import upsert
from tablegate.operators.once import computed_once
from tablegate.operators.validate import (
    MAX_REJECT_RATIO,
    DataQualityError,
    failure_message,
    gate_report,
    reasons,
)
from tablegate.session import materialize, read_if_exists, staged
from tablegate.sources.contract import Contract
from tablegate.sources.landing import BUCKETS, land_units, with_metadata
from tablegate.sources.payloads import flatten_series, latest_documents, unknown_names, with_series
from tablegate.sources.quarantine import quarantine_lines, write_quarantine

log = logging.getLogger(__name__)

UNIT = ["observation_date", "city_id"]

# The gate's report of no unit, for a run that fails before it.
_NO_REPORT = (
    "observation_date date, city_id string, total_rows long, accepted_rows long, "
    "rejected_rows long, reject_ratio double, passed boolean"
)

# Target column of each hourly series.
WEATHER_SERIES = {
    "temperature_2m_c": "temperature_2m",
    "relative_humidity_2m_pct": "relative_humidity_2m",
    "precipitation_mm": "precipitation",
    "wind_speed_10m_kmh": "wind_speed_10m",
    "weather_code": "weather_code",
}


@dataclass(frozen=True)
class Store:
    """Where a dataset's tables live; landing and quarantine have ``buckets`` a day."""

    root: str
    buckets: int = BUCKETS

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def marts(self) -> str:
        return f"{self.root}/marts"


def raw_schema(contract: Contract) -> T.StructType:
    """Accepted rows plus the loader's columns and the day they are stored under."""
    schema = contract.to_struct()
    for name, kind in (
        ("_ingested_at_utc", T.TimestampNTZType()),
        ("_batch_id", T.StringType()),
        ("_source_payload_hash", T.StringType()),
        ("_contract_version", T.IntegerType()),
        ("observation_date", T.DateType()),
    ):
        schema.add(name, kind)
    return schema


def preflight(contract: Contract, catalogue: DataFrame) -> None:
    """The contract's types must be known to Spark, and there must be a city."""
    contract.to_struct()
    if catalogue.isEmpty():
        raise ValueError("no city in the catalogue")


def ingest_units(
    spark: SparkSession,
    payloads: DataFrame,
    catalogue: DataFrame,
    contract: Contract,
    store: Store,
    run_id: str,
    plan: DataFrame | None = None,
    series: Mapping[str, str] = WEATHER_SERIES,
    max_reject_ratio: float = MAX_REJECT_RATIO,
    full_refresh: bool = False,
    land_only: bool = False,
    started_at: datetime | None = None,
    days: tuple[date, date] | None = None,
    delivered: Sequence[str] = (),
) -> DataFrame:
    """Ingest one payload (``city_id, observation_date, payload``) per unit.

    Returns one row per unit with status, counts, error and the names of series
    in its payload that the contract does not know. A planned unit without
    payload or rows is a failure, not an empty batch, and so is a payload that no plan
    asked for. Of several documents of a unit the last by the columns ``delivered`` is
    taken, as a whole. ``full_refresh`` ignores earlier loads and updates matched rows even
    when the hash is equal. ``days``, if known, limits how much of the audit is read.
    A failure on the way is audited for every unit that was to load, and raised.
    """
    preflight(contract, catalogue)
    started = started_at or datetime.now(tz=UTC)
    payloads = latest_documents(payloads, UNIT, delivered)
    places = catalogue.select(
        "city_id",
        F.col("latitude").alias("_latitude"),
        F.col("longitude").alias("_longitude"),
        F.lit(True).alias("_known"),
    )
    # A payload of a city that the catalogue does not have is a failed unit, not a lost one.
    parsed = _parsed(payloads.join(small(places), "city_id", "left"), contract, series)
    parsed = parsed.withColumn(
        "_problem", F.when(F.col("_known"), F.col("_problem")).otherwise(F.lit("unknown city"))
    ).drop("_known")
    previous = None
    if not (full_refresh or land_only):
        previous = read_if_exists(spark, store.audit, AUDIT_SCHEMA)
    if previous is not None and days is not None:
        previous = previous.filter(F.col("observation_date").between(*days))

    # One narrow pass decides per unit; only units still to load are flattened.
    units = materialize(_unit_states(parsed, plan, previous))
    to_load = units.filter(F.col("problem").isNull() & ~F.col("already_loaded"))
    todo = semi_join(parsed, to_load, UNIT)

    report = spark.createDataFrame([], _NO_REPORT)
    try:
        with staged(_checked_rows(todo, contract, series), "checked-rows") as rows:
            report = materialize(gate_report(rows, UNIT, F.col("_rejected"), max_reject_ratio))
            rejected = rows.filter("_rejected")
            lines = quarantine_lines(rejected, contract, UNIT, started, F.col("_row"))
            write_quarantine(lines, store.quarantine, UNIT, to_load, store.buckets)

            passing = anti_join(rows.filter("not _rejected"), report.filter("not passed"), UNIT)
            accepted = with_metadata(
                passing.drop("_rejected", "_reasons", "_row"),
                {
                    "_ingested_at_utc": utc_literal(started),
                    "_batch_id": batch_id("city_id", "observation_date", contract.version),
                    "_contract_version": F.lit(contract.version),
                },
            )
            land_units(accepted, store.landing, UNIT, report.filter("passed"), store.buckets)
            if land_only:
                return materialize(_results(units, report, None, contract, max_reject_ratio))
            counts = _load(spark, accepted, contract, store, full_refresh)
    except Exception as error:
        if not land_only:
            failed = _results(units, report, None, contract, max_reject_ratio, str(error))
            _write_audit(failed, store, contract, run_id, started)
        raise
    results = materialize(_results(units, report, counts, contract, max_reject_ratio))
    _write_audit(results, store, contract, run_id, started)
    return results


def _parsed(payloads: DataFrame, contract: Contract, series: Mapping[str, str]) -> DataFrame:
    """Payloads with their arrays, their hash and what is wrong with them."""
    parsed = with_series(payloads, series, "city_id").withColumn(
        "_source_payload_hash", document_hash("_document")
    )
    names = F.array_join(unknown_names(series), ", ")
    parsed = computed_once(parsed, {"_unknown": F.nullif(names, F.lit(""))})
    if contract.unknown_field_action != "reject":
        return parsed
    problem = F.concat(F.lit("unknown fields not allowed by contract: "), F.col("_unknown"))
    return parsed.withColumn("_problem", F.coalesce(problem, "_problem"))


def _unit_states(
    parsed: DataFrame, plan: DataFrame | None, previous: DataFrame | None
) -> DataFrame:
    """One row per unit: payload hash, problem, and whether it is loaded already."""
    units = parsed.select(
        *UNIT,
        F.col("_source_payload_hash").alias("source_payload_hash"),
        F.col("_problem").alias("problem"),
        F.col("_unknown").alias("unknown_fields"),
    )
    if plan is not None:
        planned = plan.select(*UNIT, F.lit(True).alias("_planned"))
        nothing = F.col("source_payload_hash").isNull() & F.col("problem").isNull()
        unasked = F.col("_planned").isNull() & F.col("problem").isNull()
        problem = (
            F.when(unasked, "unit was not planned")
            .when(nothing, "producer returned no rows")
            .otherwise(F.col("problem"))
        )
        both = planned.join(units, UNIT, "full")
        units = both.withColumn("problem", problem).drop("_planned")
    if previous is None:
        return units.withColumn("already_loaded", F.lit(False))
    return loaded_before(units, previous)


def _load(spark, accepted: DataFrame, contract: Contract, store: Store, full_refresh: bool):
    """Merge accepted rows; the raw table is stored under the day of the reading itself."""
    source = accepted.withColumn("observation_date", F.to_date("observed_at_utc"))
    schema = raw_schema(contract)
    return upsert(
        spark,
        store.raw,
        source.select(schema.names),
        keys=contract.primary_key,
        partition="observation_date",
        guard=None if full_refresh else "_source_payload_hash",
        latest_by=["_ingested_at_utc"],
        count_by=["_batch_id"],
        schema=schema,
    )


def _checked_rows(parsed: DataFrame, contract: Contract, series: Mapping[str, str]) -> DataFrame:
    """Flattened rows, typed and checked."""
    time = contract.primary_key[-1]
    flat = flatten_series(
        parsed,
        series,
        keep=[*UNIT, "_source_payload_hash"],
        time=time,
        defaults={"latitude": "_latitude", "longitude": "_longitude"},
    )
    fields = [c for c in contract.field_names if c in flat.columns]
    prepared = contract.prepare(flat)
    decoded = [c for c in prepared.columns if c not in flat.columns]
    checked = prepared.withColumn("_reasons", reasons(prepared.select(*fields, *decoded), contract))
    rejected = F.size("_reasons") > 0
    return checked.select(
        "observation_date",
        *contract.typed(prepared),
        "_source_payload_hash",
        "_reasons",
        rejected.alias("_rejected"),
        F.when(rejected, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})).alias("_row"),
    )


def _results(units, report, counts, contract, max_reject_ratio, error=None) -> DataFrame:
    """Status and counts per unit; all inputs have one row per unit.

    ``error`` is the failure of the merge, shared by all units it was to load.
    """
    results = units.join(report, UNIT, "left").withColumn(
        "batch_id", batch_id("city_id", "observation_date", contract.version)
    )
    if counts is None:
        results = results.withColumns({"rows_inserted": F.lit(0), "rows_updated": F.lit(0)})
    else:
        # A batch may hold readings of more than one day.
        changed = counts.groupBy(F.col("_batch_id").alias("batch_id")).agg(
            F.sum("rows_inserted").alias("rows_inserted"),
            F.sum("rows_updated").alias("rows_updated"),
        )
        results = results.join(changed, "batch_id", "left")
    refused = ~F.coalesce("passed", F.lit(True))
    message = failure_message(contract, UNIT[::-1], max_reject_ratio)
    zero = F.lit(0).cast("long")
    broken = F.col("problem").isNotNull() | refused
    if error is not None:
        broken = broken | ~F.col("already_loaded")
    return results.select(
        *UNIT,
        "batch_id",
        "source_payload_hash",
        F.coalesce("total_rows", zero).alias("rows_fetched"),
        F.when(refused, zero).otherwise(F.coalesce("accepted_rows", zero)).alias("rows_accepted"),
        F.coalesce("rejected_rows", zero).alias("rows_rejected"),
        F.coalesce(F.col("rows_inserted").cast("long"), zero).alias("rows_inserted"),
        F.coalesce(F.col("rows_updated").cast("long"), zero).alias("rows_updated"),
        F.when(broken, FAILED)
        .when(F.col("already_loaded"), SKIPPED)
        .otherwise(LOADED)
        .alias("status"),
        F.coalesce(
            "problem", F.when(refused, message), F.when(broken, F.lit(error))
        ).alias("error_message"),
        "unknown_fields",
    )


def _write_audit(results, store, contract, run_id, started) -> None:
    audit_append(
        results.withColumns(
            {
                "run_id": F.lit(run_id),
                "dataset": F.lit(contract.name),
                "contract_version": F.lit(contract.version),
                "started_at_utc": utc_literal(started),
                "finished_at_utc": utc_literal(datetime.now(tz=UTC)),
            }
        ),
        store.audit,
    )


def ingest_range(
    spark: SparkSession,
    payloads: DataFrame,
    catalogue: DataFrame,
    contract: Contract,
    store: Store,
    run_id: str,
    start: date,
    end: date,
    as_of: date,
    strict: bool = False,
    max_days: int | None = None,
    **options,
) -> DataFrame:
    """Ingest every (city, day) of an inclusive range and return the run summary.

    The end is cut to the newest day the producer can have; when nothing is left
    the summary is all zero and no work is done. ``strict`` raises when a unit
    failed, after all others went through. ``max_days`` refuses a longer range.
    """
    preflight(contract, catalogue)
    window = clamp_range(start, end, as_of, contract.source_lag_days)
    if window is None:
        log.warning("nothing to do: %s lies after the producer's newest day", start)
        nothing = T.StructType(
            [T.StructField(f"rows_{k}", T.LongType()) for k in ("inserted", "updated", "rejected")]
            + [T.StructField("status", T.StringType())]
        )
        return run_summary(spark.createDataFrame([], nothing))
    first, last = window
    if last < end:
        log.warning("range cut to the producer's newest day: %s instead of %s", last, end)
    plan = work_units(catalogue, first, last, max_days=max_days)
    results = ingest_units(
        spark,
        payloads.filter(F.col("observation_date").between(first, last)),
        catalogue,
        contract,
        store,
        run_id,
        plan=plan,
        days=window,
        **options,
    )
    if strict:
        failed = results.filter(F.col("status") == FAILED).orderBy(*UNIT).first()
        if failed is not None:
            raise DataQualityError(
                f"{failed['city_id']} {failed['observation_date']}: {failed['error_message']}"
            )
    return run_summary(results)
