"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(data_type: T.DataType) -> bool:
    match data_type:
        case T.MapType() | T.VariantType():
            return False
        case T.ArrayType():
            return _orderable(data_type.elementType)
        case T.StructType():
            return all(_orderable(f.dataType) for f in data_type)
        case _:
            return True


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    ties: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the greatest ``order_by``, ties broken by every other column.

    Spark puts a group limit before the shuffle, so each map task sends at most
    one row per key and a key with very many copies stays cheap.
    """
    if ties is None:
        used = {*keys, *order_by}
        ties = [
            F.col(f.name).desc_nulls_last()
            for f in df.schema
            if f.name not in used and _orderable(f.dataType)
        ]
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in order_by], *ties
    )
    return (
        df.withColumn("_row_number", F.row_number().over(window))
        .filter(F.col("_row_number") == 1)
        .drop("_row_number")
    )
