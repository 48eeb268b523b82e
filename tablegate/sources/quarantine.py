"""Quarantine: rejected rows as JSON lines, with the reasons.

JSON on purpose: the rows are here because they do not fit a schema.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.sources.contract import Contract
from tablegate.sources.landing import BUCKET, BUCKETS, replace_units
from tablegate.sources.publish import read_table

LINE_SCHEMA = T.StructType(
    [
        T.StructField("_quarantined_at_utc", T.StringType()),
        T.StructField("_contract", T.StringType()),
        T.StructField("_reasons", T.ArrayType(T.StringType())),
        T.StructField("row", T.StringType()),
    ]
)


def quarantine_lines(
    rejected: DataFrame,
    contract: Contract,
    unit: Sequence[str],
    at: datetime,
    row: Column | None = None,
) -> DataFrame:
    """Unit keys plus the four fields of a line.

    ``row`` is the rejected row as JSON text, by default all of its columns.
    """
    if row is None:
        fields = [c for c in rejected.columns if c != "_reasons"]
        row = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rejected.select(
        *unit,
        F.lit(at.isoformat()).alias("_quarantined_at_utc"),
        F.lit(contract.id).alias("_contract"),
        "_reasons",
        row.alias("row"),
    )


def write_quarantine(
    lines: DataFrame,
    path: str,
    unit: Sequence[str],
    run_units: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Replace the quarantine of the run's units, by default of those with lines.

    Lines are stored by the first unit key and a bucket of the others, which are fields of
    the line. A unit of ``run_units`` that is clean now loses its old lines.
    """
    units = lines if run_units is None else run_units
    schema = T.StructType([*LINE_SCHEMA, *lines.select(*unit).schema])
    replace_units(lines, path, unit, units.select(*unit).distinct(), buckets, schema, "json")


def read_quarantine(spark: SparkSession, path: str, unit_schema: T.StructType) -> DataFrame:
    """Quarantined rows below ``path``; nothing written yet gives no rows."""
    schema = T.StructType([*LINE_SCHEMA, *unit_schema])
    lines = read_table(spark, path, schema, "json")
    if lines is None:
        return spark.createDataFrame([], schema)
    return lines.drop(BUCKET).filter(F.size("_reasons") > 0)
