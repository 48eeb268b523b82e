"""Banding and order-independent sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column | str, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower bound is reached; nulls fall to ``otherwise``."""
    value = F.col(value) if isinstance(value, str) else value
    result = None
    for bound, label in steps:
        reached = value >= bound
        result = F.when(reached, label) if result is None else result.when(reached, label)
    return F.lit(otherwise) if result is None else result.otherwise(otherwise)


# Doubles added in another order differ in the last digits, and a rounding tie
# then flips between runs. Values that fixed point holds, but for the noise of an earlier
# subtraction, are added in it, so a rebuilt aggregate is identical; all others (very large
# or small, more digits, NaN, infinity) are added as they are.
_FIXED = "decimal(18,6)"
_NOISE = 1e-12


def _parts(value: Column | str) -> tuple[Column, Column]:
    """The value in fixed point where that changes nothing but noise, else as a double."""
    value = F.col(value) if isinstance(value, str) else value
    plain, fixed = value.cast("double"), value.try_cast(_FIXED)
    held = F.abs(fixed.cast("double") - plain) <= F.abs(plain) * _NOISE
    held = F.coalesce(held, F.lit(False))
    return F.when(held, fixed), F.when(~held, plain)


def exact_sum(value: Column | str, digits: int = 2) -> Column:
    fixed, other = _parts(value)
    total = F.coalesce(F.sum(fixed).cast("double"), F.lit(0.0)) + F.sum(other)
    return F.when(F.count(other) == 0, F.round(F.sum(fixed), digits).cast("double")).otherwise(
        F.round(total, digits)
    )


def exact_avg(value: Column | str, digits: int = 2) -> Column:
    fixed, other = _parts(value)
    total = F.coalesce(F.sum(fixed).cast("double"), F.lit(0.0)) + F.sum(other)
    return F.when(F.count(other) == 0, F.round(F.avg(fixed), digits).cast("double")).otherwise(
        F.round(total / (F.count(fixed) + F.count(other)), digits)
    )
