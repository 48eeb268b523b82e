"""Columns that are computed once per row, however often they are used."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add costly columns (parsed JSON and the like) that later steps refer to.

    A filter on a plain projected column is pushed below the projection, and the
    column's expression then takes its place at every mention: a document would
    be parsed a dozen times. Filters do not pass a generator, and this one makes
    exactly one row of each row. Filters on other columns still reach the scan.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
