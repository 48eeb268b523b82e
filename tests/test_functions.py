from __future__ import annotations

import hashlib
import math
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tablegate.functions import (
    band,
    batch_id,
    exact_avg,
    exact_sum,
    hour_start,
    iso_weekday,
    number_text,
    parse_utc,
    payload_hash,
    row_hash,
    surrogate_key,
    utc_literal,
)


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_batch_id(spark):
    df = spark.createDataFrame([("oslo", date(2025, 3, 20))], "c string, d date")
    expected = hashlib.sha256(b"oslo|2025-03-20|v1").hexdigest()[:32]
    assert df.select(batch_id("c", "d")).first()[0] == expected
    assert df.select(batch_id("c", "d", 2)).first()[0] != expected


def test_payload_hash_ignores_order_not_values(spark):
    texts = ['{"a":1,"b":{"c":2,"d":[1,2]}}', '{"b": {"d": [1, 2], "c": 2}, "a": 1}', '{"a":2,"b":{"c":2,"d":[1,2]}}', "no"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    first, same, other, broken = [r[0] for r in df.select(payload_hash("t")).collect()]
    assert first == same and first != other and broken is None
    assert first == hashlib.sha256(b'{"a":1,"b":{"c":2,"d":[1,2]}}').hexdigest()


def test_surrogate_key(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", datetime(2025, 3, 20, 5))], "k string, t timestamp_ntz"
    )
    empty, full = [r[0] for r in df.select(surrogate_key(df, ["k", "t"])).collect()]
    assert empty == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert full == hashlib.md5(b"a-2025-03-20 05:00:00.000000").hexdigest()


def test_row_hash_sees_nulls(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert df.select(row_hash("a", "b").alias("h")).distinct().count() == 2


@pytest.mark.parametrize(
    "value",
    [999.0, -91.5, 0.0, 0.1, 1e7, 12345678.9, 9.99e15, 1e16, 1.5e20, 0.00012, 0.001, 1e-5, 1.25e-7, 1e100, 123456789012.345, float("inf"), float("nan")],
)
def test_number_text(spark, value):
    assert one(spark, value, "double", number_text) == repr(value)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-03-20T05:00", datetime(2025, 3, 20, 5)),
        ("2025-03-20T05:00:30", datetime(2025, 3, 20, 5, 0, 30)),
        ("2025-03-20T05:00+02:00", datetime(2025, 3, 20, 3)),
        ("2025-03-20T05:00:00-0330", datetime(2025, 3, 20, 8, 30)),
        ("2025-03-20T05:00Z", datetime(2025, 3, 20, 5)),
        ("2025-03-20", datetime(2025, 3, 20)),
        ("noon", None),
        (None, None),
    ],
)
def test_parse_utc(spark, text, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, text, "string", parse_utc) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_no_hour_is_lost_to_daylight_saving(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        skipped = datetime(2024, 3, 10, 2, 30)  # does not exist in New York
        df = spark.createDataFrame([(skipped, date(2024, 3, 10))], "t timestamp_ntz, d date")
        shifted = datetime(2024, 3, 10, 2, 30, tzinfo=timezone(timedelta(hours=2)))
        row = df.select(
            hour_start("t").alias("start"),
            F.hour("t").alias("hour"),
            surrogate_key(df, ["t"]).alias("key"),
            (utc_literal(skipped) == F.col("t")).alias("same"),
            utc_literal(shifted).alias("shifted"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.start, row.hour, row.same) == (datetime(2024, 3, 10, 2), 2, True)
    assert row.key == hashlib.md5(b"2024-03-10 02:30:00.000000").hexdigest()
    assert row.shifted == datetime(2024, 3, 10, 0, 30)


def test_time_parts(spark):
    sunday = datetime(2025, 3, 23, 5, 59, 59)
    assert one(spark, sunday, "timestamp_ntz", hour_start) == datetime(2025, 3, 23, 5)
    assert one(spark, sunday, "timestamp_ntz", iso_weekday) == 7


def test_band(spark):
    df = spark.createDataFrame([(v,) for v in (2_000_000, 1_999_999, 1_000_000, 5, None)], "p long")
    steps = ((2_000_000, "large"), (1_000_000, "medium"))
    found = [r[0] for r in df.select(band("p", steps, "small")).collect()]
    assert found == ["large", "medium", "medium", "small", "small"]


def test_exact_aggregates_round_ties_up(spark):
    df = spark.createDataFrame([(1.01,), (1.02,), (None,)], "v double")
    row = df.agg(exact_avg("v").alias("a"), exact_sum("v").alias("s")).first()
    assert (row.a, row.s) == (1.02, 2.03)


@pytest.mark.parametrize(
    ("values", "average", "total"),
    [
        ([1e13, 2e13], 1.5e13, 3e13),
        ([4e-7, 8e-7, None], 6e-7, 1.2e-6),
        ([1e13, 0.5], 5000000000000.25, 10000000000000.5),
        ([math.inf, 1.0], math.inf, math.inf),
        ([math.nan, 1.0], math.nan, math.nan),
        ([None], None, None),
    ],
)
def test_exact_aggregates_keep_every_value(spark, values, average, total):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = df.agg(exact_avg("v", 8).alias("a"), exact_sum("v", 8).alias("s")).first()
    assert (row.a, row.s) == pytest.approx((average, total), nan_ok=True)
