"""UTC time without dependence on the session time zone."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(?:[Zz]|[+-]\d{2}:?\d{2})$"


def parse_utc(text: Column) -> Column:
    """ISO text to a UTC ``timestamp_ntz``; null when it is not a timestamp.

    A text without an offset is taken as UTC, one with an offset is converted.
    """
    offset = F.regexp_extract(text, r"[+-]\d{2}:?\d{2}$", 0)
    local = F.regexp_replace(text, _OFFSET, "").try_cast("timestamp_ntz")
    digits = F.regexp_replace(offset, "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int")
    signed = F.when(offset.startswith("-"), minutes).otherwise(-minutes)
    shifted = (local + F.make_dt_interval(mins=signed)).cast("timestamp_ntz")
    return F.when(offset == "", local).otherwise(shifted)


def utc_literal(at: datetime) -> Column:
    """A moment as ``timestamp_ntz`` in UTC; one without a zone is taken as UTC."""
    if at.tzinfo is not None:
        at = at.astimezone(UTC).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_start(ts: Column | str) -> Column:
    """Start of the hour of a ``timestamp_ntz``.

    ``date_trunc`` would go through a zoned timestamp and move the hours that a
    daylight saving change skips.
    """
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def iso_weekday(day: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + 1
