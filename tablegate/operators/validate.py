"""Row checks against a contract, and the per-unit gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.operators.joins import anti_join
from tablegate.session import materialize
from tablegate.sources.contract import Contract

# Fixed value: share of rejected rows above which a unit is refused.
MAX_REJECT_RATIO = 0.02


class DataQualityError(RuntimeError):
    """A unit has too many rejected rows."""


def reasons(prepared: DataFrame, contract: Contract, document: str | None = None) -> Column:
    """Array of violations in contract order, empty for a valid row.

    ``array_except`` drops the nulls of rules that hold; unlike ``filter`` with
    a lambda it stays inside generated code.
    """
    messages = [F.when(rule.failed, rule.message) for rule in contract.rules(prepared, document)]
    missing = F.lit(None).cast("string")
    return F.array_except(F.array(*messages, missing), F.array(missing))


def violates(prepared: DataFrame, contract: Contract, document: str | None = None) -> Column:
    """True for a row with any violation; builds no message text."""
    failed = [rule.failed for rule in contract.rules(prepared, document)]
    return reduce(or_, failed, F.lit(False))


def validate(df: DataFrame, contract: Contract, document: str | None = None) -> DataFrame:
    """Add ``_reasons`` to every row."""
    prepared = contract.prepare(df, document)
    found = reasons(prepared, contract, document).alias("_reasons")
    return prepared.select(*df.columns, found)


def flagged(df: DataFrame, contract: Contract, document: str | None = None) -> DataFrame:
    """Add ``_rejected`` to every row, without the text of the reasons."""
    prepared = contract.prepare(df, document)
    return prepared.select(*df.columns, violates(prepared, contract, document).alias("_rejected"))


def split_valid(
    df: DataFrame, contract: Contract, document: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``_reasons``)."""
    prepared = contract.prepare(df, document)
    bad = violates(prepared, contract, document)
    found = reasons(prepared, contract, document).alias("_reasons")
    accepted = prepared.filter(~bad).select(*df.columns)
    return accepted, prepared.filter(bad).select(*df.columns, found)


def unknown_fields(
    df: DataFrame, contract: Contract, document: str, unit: Sequence[str]
) -> DataFrame:
    """Per unit, each field the contract does not describe and its row count.

    One row per name, so no unit's names are gathered in one place. Every row is
    looked at, not a sample.
    """
    return (
        df.select(*unit, F.explode(contract.unknown_names(F.col(document))).alias("field"))
        .groupBy(*unit, "field")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def gate_report(
    df: DataFrame,
    unit: Sequence[str],
    rejected: Column,
    max_reject_ratio: float = MAX_REJECT_RATIO,
) -> DataFrame:
    """Rows, accepted, rejected, ratio and verdict per unit."""
    counts = df.groupBy(*unit).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~rejected).alias("accepted_rows"),
        F.count_if(rejected).alias("rejected_rows"),
    )
    return with_verdict(counts, max_reject_ratio)


def with_verdict(counts: DataFrame, max_reject_ratio: float = MAX_REJECT_RATIO) -> DataFrame:
    ratio = F.when(F.col("total_rows") == 0, 0.0).otherwise(
        F.col("rejected_rows") / F.col("total_rows")
    )
    return counts.withColumn("reject_ratio", ratio).withColumn(
        "passed", F.col("reject_ratio") <= F.lit(max_reject_ratio)
    )


def failure_message(contract: Contract, unit: Sequence[str], max_reject_ratio: float) -> Column:
    """Text for a refused unit, over the columns of :func:`gate_report`."""
    return F.format_string(
        f"%s: %d of %d rows rejected (%.1f%%, limit {max_reject_ratio * 100:.1f}%%) "
        f"by {contract.name} v{contract.version}",
        F.concat_ws(" ", *[F.col(c).cast("string") for c in unit]),
        F.col("rejected_rows"),
        F.col("total_rows"),
        F.col("reject_ratio") * 100,
    )


@dataclass(frozen=True)
class Gated:
    """``accepted`` holds valid rows of passing units, ``rejected`` every
    invalid row, ``report`` one row per unit."""

    report: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def gate(
    df: DataFrame,
    contract: Contract,
    unit: Sequence[str],
    max_reject_ratio: float = MAX_REJECT_RATIO,
    document: str | None = None,
    strict: bool = False,
) -> Gated:
    """Split the rows and hold back units with too many rejects.

    The report is one narrow aggregation and is kept, since it decides what is
    joined: with no refused unit the rows are never shuffled. ``strict`` raises
    when any unit is refused.
    """
    checked = flagged(df, contract, document)
    report = materialize(gate_report(checked, unit, F.col("_rejected"), max_reject_ratio))
    refused = report.filter(~F.col("passed"))
    if strict:
        message = failure_message(contract, unit, max_reject_ratio)
        first = refused.orderBy(*unit).select(message.alias("m")).first()
        if first is not None:
            raise DataQualityError(first["m"])
    accepted, rejected = split_valid(df, contract, document)
    return Gated(report, anti_join(accepted, refused, unit), rejected)


def empty_units(plan: DataFrame, rows: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Planned units for which the producer returned no rows."""
    present = rows.select(*unit).distinct()  # a unit of any size becomes one row
    return plan.select(*unit).join(present, list(unit), "left_anti")
