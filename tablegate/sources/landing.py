"""Landing zone: partitioned Parquet, by unit, or by day and bucket of the other keys.

Re-running a unit replaces exactly its rows. Partitions are published all or none
(``sources.publish``), so readers never see half a write and a lost executor only
repeats its tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.joins import anti_join
from tablegate.session import materialize
from tablegate.sources.publish import (
    Folder,
    partition_name,
    read_table,
    record_schema,
    recover,
    replace_partitions,
)

BUCKET = "unit_bucket"
BUCKETS = 16


def with_metadata(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Attach the loader's own columns (ingestion time, batch id, hash, version)."""
    return df.withColumns(dict(columns))


def land(
    df: DataFrame, path: str, unit: Sequence[str] = ("observation_date", "city_id")
) -> None:
    """Write landed rows, one partition per unit; a re-run replaces the partition.

    The partition is dropped as a whole, so a rebuilt unit keeps nothing of what
    was landed for it before. With very many units see :func:`land_units`.
    """
    replace_partitions(df, path, unit)


def bucket(unit: Sequence[str], buckets: int) -> Column:
    """The bucket of a unit within its day, from its keys but the first."""
    return F.pmod(F.xxhash64(*unit[1:]), F.lit(buckets)).cast("int")


def replace_units(
    rows: DataFrame,
    path: str,
    unit: Sequence[str],
    units: DataFrame,
    buckets: int,
    schema: T.StructType | None = None,
    file_format: str = "parquet",
) -> None:
    """Replace all rows of ``units`` in a table stored by the first unit key and a bucket.

    The number of folders does not depend on the number of units. Other units of the
    touched partitions are read and written again; partitions that did not exist before,
    as those of a new day, are only written. ``units`` are distinct unit keys and may name
    units without rows, which then have none.
    """
    spark, first = rows.sparkSession, unit[0]
    recover(spark, path)
    old = read_table(spark, path, schema, file_format)
    stored = rows.withColumn(BUCKET, bucket(unit, buckets))
    # Days times buckets at most, like the folders themselves.
    places = units.select(first, bucket(unit, buckets).alias(BUCKET)).distinct().collect()
    touched = [partition_name(spark, place.asDict()) for place in places]
    folder = Folder(spark, path)
    there = [place for place, name in zip(places, touched) if folder.exists(name)]
    if old is not None and there:
        at = F.concat_ws("/", F.coalesce(F.col(first).cast("string"), F.lit("")), F.col(BUCKET).cast("string"))
        names = [f"{'' if place[0] is None else place[0]}/{place[1]}" for place in there]
        kept = anti_join(old.filter(at.isin(names)), materialize(units.select(*unit)), unit)
        stored = stored.unionByName(kept, allowMissingColumns=True)
    if file_format == "parquet":
        record_schema(spark, path, stored.schema)
    replace_partitions(stored, path, [first, BUCKET], unit[1:], file_format, touched=touched)


def land_units(
    df: DataFrame, path: str, unit: Sequence[str], units: DataFrame, buckets: int = BUCKETS
) -> None:
    """Write landed rows by day and bucket; ``units`` lose what was landed for them before."""
    replace_units(df, path, unit, units, buckets)


def read_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Landed rows, with partition columns typed by ``schema`` and not inferred."""
    rows = read_table(spark, path, schema)
    if rows is None:
        rows = spark.read.schema(schema).parquet(path)
    return rows.select(*columns) if columns else rows.drop(BUCKET)


def landed_hashes(
    landed: DataFrame, unit: Sequence[str], source_hash: str = "_source_payload_hash"
) -> DataFrame:
    """The payload hash each landed unit came from."""
    return landed.groupBy(*unit).agg(F.any_value(source_hash, True).alias(source_hash))
