"""Column functions; all of them stay inside the JVM."""

from tablegate.functions.identity import batch_id, canonical_json, payload_hash, row_hash, surrogate_key
from tablegate.functions.text import number_text
from tablegate.functions.time import hour_start, iso_weekday, parse_utc, utc_literal
from tablegate.functions.values import band, exact_avg, exact_sum

__all__ = [
    "band",
    "batch_id",
    "canonical_json",
    "exact_avg",
    "exact_sum",
    "hour_start",
    "iso_weekday",
    "number_text",
    "parse_utc",
    "payload_hash",
    "row_hash",
    "surrogate_key",
    "utc_literal",
]
