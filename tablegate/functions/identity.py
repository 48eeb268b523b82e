"""Deterministic identities: equal data gives equal ids on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key separator and id length of a batch id; null marker and
# separator of a surrogate key.
BATCH_SEPARATOR = "|"
BATCH_ID_LENGTH = 32
NULL_KEY = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def batch_id(entity: Column | str, day: Column | str, version: int = 1) -> Column:
    """Id of one (entity, day) batch under a contract version."""
    key = F.concat(
        _col(entity).cast("string"),
        F.lit(BATCH_SEPARATOR),
        _col(day).cast("date").cast("string"),
        F.lit(f"{BATCH_SEPARATOR}v{version}"),
    )
    return F.substring(F.sha2(key, 256), 1, BATCH_ID_LENGTH)


def canonical_json(document: Column | str) -> Column:
    """Compact JSON text with sorted keys at every depth, null if malformed.

    ``document`` is JSON text. Numbers are normalised too (18.0 and 18 are the
    same value), so a mere change of number format is no change.
    """
    return F.to_json(F.try_parse_json(_col(document)))


def payload_hash(document: Column | str) -> Column:
    """SHA-256 of the canonical form of a JSON text."""
    return F.sha2(canonical_json(document), 256)


def document_hash(document: Column | str) -> Column:
    """The same for a document that is parsed already."""
    return F.sha2(F.to_json(_col(document)), 256)


def _key_text(column: Column, data_type: T.DataType) -> Column:
    text = column.cast("string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        # The cast drops trailing zeros of the fraction; six digits are restored.
        whole = F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text)
        return F.rpad(whole, 26, "0")
    return text


def surrogate_key(df: DataFrame, columns: list[str]) -> Column:
    """MD5 over the text of several columns, nulls included."""
    parts = [
        F.coalesce(_key_text(F.col(c), df.schema[c].dataType), F.lit(NULL_KEY)) for c in columns
    ]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def row_hash(*columns: Column | str) -> Column:
    """SHA-256 of the values of a row, for a guard finer than the payload hash."""
    return F.sha2(F.to_json(F.struct(*[_col(c) for c in columns]), {"ignoreNullFields": "false"}), 256)
