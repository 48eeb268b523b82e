"""Joins that stay even under hot keys.

Spark broadcasts a side by itself when the files behind it are small, and AQE
splits a skewed left side of inner, left, semi and anti joins. What is added
here is only a measured broadcast for small derived frames, whose size Catalyst
cannot know in advance.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.session import BROADCAST_LIMIT_BYTES, materialize, measured


def small(df: DataFrame) -> DataFrame:
    """``df`` computed once, and marked for broadcast if its size allows that.

    For dimensions that are derived rather than read from small files.
    """
    kept = materialize(df)
    return F.broadcast(kept) if measured(kept)[1] <= BROADCAST_LIMIT_BYTES else kept


def _matching(rows: DataFrame, keys: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    renamed = keys.select([F.col(c).alias(f"__key_{c}") for c in on])
    count, size = measured(renamed)
    if count == 0:
        return rows if how == "left_anti" else rows.limit(0)
    if size <= BROADCAST_LIMIT_BYTES:
        renamed = F.broadcast(renamed)
    match = reduce(and_, [rows[c].eqNullSafe(renamed[f"__key_{c}"]) for c in on])
    return rows.join(renamed, match, how)


def anti_join(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``keys``; untouched when there are none.

    ``keys`` should be materialised: it is measured first. It is broadcast only
    below the limit, otherwise the join shuffles and AQE splits hot keys of
    ``rows``. Null keys match each other.
    """
    return _matching(rows, keys, on, "left_anti")


def semi_join(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is among ``keys``; same strategy as :func:`anti_join`."""
    return _matching(rows, keys, on, "left_semi")
