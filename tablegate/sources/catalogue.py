"""The entity catalogue: a CSV with a fixed schema and bounds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CatalogueError(ValueError):
    """The catalogue breaks a bound, or an id is not in it."""


@dataclass(frozen=True)
class Bound:
    """What a catalogue column must look like; a null never does."""

    column: str
    pattern: str | None = None
    length: int | None = None
    min: float | None = None
    max: float | None = None

    def failed(self) -> Column:
        value = F.col(self.column)
        ok = value.isNotNull()
        if self.pattern is not None:
            ok = ok & value.rlike(self.pattern)
        if self.length is not None:
            ok = ok & (F.length(value) == self.length)
        if self.min is not None:
            ok = ok & (value >= self.min)
        if self.max is not None:
            ok = ok & (value <= self.max)
        return ~F.coalesce(ok, F.lit(False))


# Columns, types and bounds of the city catalogue.
CITY_SCHEMA = T.StructType(
    [
        T.StructField("city_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone_name", T.StringType()),
        T.StructField("population", T.LongType()),
    ]
)
CITY_BOUNDS = (
    Bound("city_id", pattern=r"^[a-z0-9_]+$"),
    Bound("name"),
    Bound("country_code", length=2),
    Bound("latitude", min=-90, max=90),
    Bound("longitude", min=-180, max=180),
)


def out_of_bounds(df: DataFrame, bounds: Sequence[Bound] = CITY_BOUNDS) -> DataFrame:
    """Rows breaking a bound, with ``_broken`` naming the columns."""
    missing = F.lit(None).cast("string")
    names = F.array(*[F.when(b.failed(), F.lit(b.column)) for b in bounds], missing)
    return df.withColumn("_broken", F.array_except(names, F.array(missing))).filter(
        F.size("_broken") > 0
    )


def read_catalogue(
    spark: SparkSession,
    path: str,
    only: Sequence[str] | None = None,
    schema: T.StructType = CITY_SCHEMA,
    bounds: Sequence[Bound] = CITY_BOUNDS,
    key: str = "city_id",
) -> DataFrame:
    """Read and check the catalogue, optionally only some ids.

    A malformed line, a broken bound or an unknown id is an error. Columns are
    matched by the header, whatever their order.
    """
    raw = spark.read.csv(path, header=True, schema=None)
    absent = [f.name for f in schema if f.name not in raw.columns]
    if absent:
        raise CatalogueError(f"catalogue has no column {absent}")
    ordered = T.StructType([schema[c] if c in schema.names else raw.schema[c] for c in raw.columns])
    rows = spark.read.csv(path, header=True, schema=ordered, mode="FAILFAST").select(schema.names)

    broken = out_of_bounds(rows, bounds).select(key, "_broken").limit(1).collect()
    if broken:
        raise CatalogueError(f"catalogue row {broken[0][0]!r} breaks {list(broken[0][1])}")
    if not only:
        return rows
    chosen = rows.filter(F.col(key).isin(list(only)))
    found = {r[0] for r in chosen.select(key).distinct().collect()}  # at most len(only) ids
    if unknown := sorted(set(only) - found):
        raise CatalogueError(f"unknown ids: {unknown}")
    return chosen
