"""Text of values as they appear in rejection reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(value: Column) -> Column:
    """Shortest text of a double: plain notation from 1e-4 up to 1e16.

    Spark itself turns to an exponent at 1e7 and below 1e-3; those two bands go
    through a decimal, which holds every digit a double can have there.
    """
    size, text = F.abs(value), value.cast("string")
    decimal = F.when(size >= 1, value.try_cast("decimal(38,10)").cast("string")).otherwise(
        value.try_cast("decimal(38,24)").cast("string")
    )
    plain = F.regexp_replace(decimal, r"(\.\d*[1-9]|\.0)0*$", "$1")
    # 1.0E20 -> 1e+20, 1.5E-7 -> 1.5e-07
    exponent = F.format_string(
        "%se%+03d",
        F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""),
        F.substring_index(text, "E", -1).try_cast("int"),
    )
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(size < float("inf"), exponent)
        .otherwise(F.lower(F.replace(text, F.lit("Infinity"), F.lit("inf"))))
    )
