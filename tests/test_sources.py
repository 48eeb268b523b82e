from __future__ import annotations

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.validate import gate, split_valid, validate
from tablegate.plans.ingest import WEATHER_SERIES
from tablegate.sources.catalogue import CatalogueError, out_of_bounds, read_catalogue
from tablegate.sources.landing import land, landed_hashes, read_landed
from tablegate.sources.payloads import (
    classify_responses,
    flatten_series,
    read_payloads,
    refused_units,
    unknown_series,
    with_series,
)
from tablegate.sources.quarantine import quarantine_lines, read_quarantine, write_quarantine
from tests.conftest import CATALOGUE, make_payload

UNIT_SCHEMA = T.StructType(
    [T.StructField("observation_date", T.DateType()), T.StructField("city_id", T.StringType())]
)


# Catalogue


def test_catalogue(spark, catalogue_path):
    rows = read_catalogue(spark, catalogue_path).orderBy("city_id").collect()
    assert [r.city_id for r in rows] == ["lima", "oslo", "porto"]
    assert rows[0].population == 10_000_000
    assert read_catalogue(spark, catalogue_path, only=["oslo"]).count() == 1


def test_catalogue_unknown_id(spark, catalogue_path):
    with pytest.raises(CatalogueError, match=r"unknown ids: \['atlantis', 'eldorado'\]"):
        read_catalogue(spark, catalogue_path, only=["oslo", "eldorado", "atlantis"])


@pytest.mark.parametrize(
    ("old", "new"), [("59.91", "159.91"), ("oslo,", "Oslo!,"), (",NO,", ",NOR,"), ("59.91", "")]
)
def test_catalogue_bounds(spark, tmp_path, old, new):
    path = tmp_path / "c.csv"
    path.write_text(CATALOGUE.replace(old, new, 1))
    with pytest.raises(CatalogueError, match="breaks"):
        read_catalogue(spark, str(path))


def test_catalogue_malformed_number_and_column_order(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(CATALOGUE.replace("59.91", "north"))
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        read_catalogue(spark, str(path)).collect()
    path.write_text("name,city_id,population,country_code,latitude,longitude,timezone_name\nOslo,oslo,7,NO,59.9,10.7,X\n")
    assert read_catalogue(spark, str(path)).first().city_id == "oslo"


def test_out_of_bounds_names_every_column(spark, catalogue):
    bad = catalogue.withColumn("latitude", F.lit(99.0)).withColumn("country_code", F.lit("X"))
    assert out_of_bounds(bad).first()["_broken"] == ["country_code", "latitude"]


# Payloads


def payloads(spark, *texts, city="oslo"):
    rows = [(date(2025, 3, 20), f"{city}{i or ''}", t, 1.0, 2.0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(
        rows, "observation_date date, city_id string, payload string, _lat double, _lon double"
    )
    return with_series(df, WEATHER_SERIES, "city_id")


def flat(parsed):
    return flatten_series(
        parsed,
        WEATHER_SERIES,
        ["observation_date", "city_id"],
        defaults={"latitude": "_lat", "longitude": "_lon"},
    )


def test_flatten(spark, contract):
    rows = flat(payloads(spark, make_payload()))
    rows = contract.prepare(rows)
    typed = rows.select(contract.typed(rows)).orderBy("observed_at_utc").collect()
    assert len(typed) == 24
    assert typed[5].observed_at_utc == datetime(2025, 3, 20, 5)
    assert typed[5].temperature_2m_c == pytest.approx(4.1)
    assert (typed[5].weather_code, typed[5].latitude) == (2, 41.15)
    assert split_valid(rows.select(contract.field_names), contract)[1].count() == 0


def test_ragged_series_is_refused(spark):
    parsed = payloads(spark, make_payload(temperature_2m=[1.0]), make_payload(precipitation=[]))
    found = {r.city_id: r.problem for r in refused_units(parsed, ["city_id"]).collect()}
    assert found == {
        "oslo": "oslo: series 'temperature_2m' holds 1 values for 24 times",
        "oslo1": "oslo1: series 'precipitation' holds 0 values for 24 times",
    }
    assert flat(parsed).count() == 0


def test_other_refusals(spark):
    parsed = payloads(
        spark, "<html>", make_payload(hours=0), "{}", make_payload(weather_code="rain")
    )
    found = [r.problem for r in refused_units(parsed, ["city_id"]).orderBy("city_id").collect()]
    assert found == [
        "payload is not JSON",
        "producer returned no rows",
        "producer returned no rows",
        "oslo3: series 'weather_code' is not an array",
    ]


def test_nulls_and_absent_series(spark, contract):
    parsed = payloads(
        spark,
        make_payload(hours=3, temperature_2m=[1.0, None, 3.0], precipitation=..., weather_code=None),
    )
    rows = contract.prepare(flat(parsed))
    typed = rows.select(contract.typed(rows)).orderBy("observed_at_utc").collect()
    assert [r.temperature_2m_c for r in typed] == [1.0, None, 3.0]
    assert [r.precipitation_mm for r in typed] == [None] * 3
    assert [r.weather_code for r in typed] == [None] * 3


def test_absent_latitude_falls_back_and_null_does_not(spark, contract):
    absent = contract.prepare(flat(payloads(spark, make_payload(hours=1, top={"latitude": ...}))))
    assert absent.select(contract.typed(absent)).first().latitude == 1.0
    null = flat(payloads(spark, make_payload(hours=1, top={"latitude": None})))
    reasons = validate(null.select(contract.field_names), contract).first()["_reasons"]
    assert reasons == ["latitude: required field is null"]


def test_wrong_type_is_seen(spark, contract):
    rows = flat(payloads(spark, make_payload(hours=2, temperature_2m=["cold", 2])))
    found = validate(rows.select(contract.field_names), contract).collect()
    assert [r["_reasons"] for r in found] == [["temperature_2m_c: expected float, got str"], []]


def test_unknown_series(spark):
    parsed = payloads(spark, make_payload(uv_index=[1]), make_payload())
    rows = unknown_series(parsed, WEATHER_SERIES, ["city_id"]).collect()
    assert [tuple(r) for r in rows] == [("oslo", "uv_index")]


def test_read_payloads(spark, tmp_path):
    for city in ("01", "02"):
        folder = tmp_path / "observation_date=2025-03-20" / f"city_id={city}"
        folder.mkdir(parents=True)
        (folder / "payload.json").write_text(json.dumps(json.loads(make_payload()), indent=1))
    rows = read_payloads(spark, str(tmp_path), UNIT_SCHEMA).orderBy("city_id").collect()
    assert [(r.city_id, r.observation_date) for r in rows] == [
        ("01", date(2025, 3, 20)),
        ("02", date(2025, 3, 20)),
    ]
    assert json.loads(rows[0].payload) == json.loads(make_payload())


def test_classify_responses(spark):
    rows = [(None, None), (429, ""), (500, ""), (503, "{}"), (400, "bad"), (404, "{}"), (200, "<html>"), (200, None), (200, '{"a":1}')]
    df = classify_responses(spark.createDataFrame(rows, "status int, body string"))
    assert [(r.outcome, r.problem) for r in df.collect()] == [
        ("transient", "transport failure"),
        ("transient", "rate limited"),
        ("transient", "returned 500"),
        ("transient", "returned 503"),
        ("permanent", "returned 400"),
        ("permanent", "returned 404"),
        ("transient", "non-JSON body"),
        ("transient", "non-JSON body"),
        ("ok", None),
    ]


# Landing

LANDED = T.StructType(
    [
        T.StructField("v", T.DoubleType()),
        T.StructField("_batch_id", T.StringType()),
        T.StructField("_source_payload_hash", T.StringType()),
        *UNIT_SCHEMA,
    ]
)


def landed(spark, day, city, n, h="h1"):
    rows = [(float(i), f"b-{city}", h, day, city) for i in range(n)]
    return spark.createDataFrame(rows, LANDED)


def test_land_overwrites_one_unit_only(spark, tmp_path):
    path, d1, d2 = str(tmp_path / "land"), date(2025, 3, 20), date(2025, 3, 21)
    land(landed(spark, d1, "01", 24).union(landed(spark, d2, "01", 24)), path)
    assert len(list((tmp_path / "land").glob("*/*/*.parquet"))) == 2  # one file per unit
    land(landed(spark, d1, "01", 3, "h2"), path)
    rows = read_landed(spark, path, LANDED)
    assert rows.count() == 27
    assert rows.first().city_id == "01"  # typed by the schema, not inferred as a number
    hashes = landed_hashes(rows, ["observation_date", "city_id"]).orderBy("observation_date")
    assert [r["_source_payload_hash"] for r in hashes.collect()] == ["h2", "h1"]
    assert read_landed(spark, path, LANDED, ["v"]).columns == ["v"]


def test_temporary_files_are_ignored(spark, tmp_path):
    path = str(tmp_path / "land")
    land(landed(spark, date(2025, 3, 20), "oslo", 2), path)
    stray = tmp_path / "land" / "observation_date=2025-03-20" / "city_id=oslo" / ".x.parquet.tmp"
    stray.write_text("half")
    assert read_landed(spark, path, LANDED).count() == 2


def test_hot_unit_is_split(spark, tmp_path):
    """One unit bigger than a task should take becomes several files."""
    rows = spark.range(0, 200_000, numPartitions=8).select(
        F.rand(1).alias("v"),
        F.lit("b").alias("_batch_id"),
        F.lit("h").alias("_source_payload_hash"),
        F.lit(date(2025, 3, 20)).alias("observation_date"),
        F.when(F.col("id") % 100 == 0, "small").otherwise("hot").alias("city_id"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "262144")
    try:
        land(rows, str(tmp_path / "land"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {c: len(list((tmp_path / "land").glob(f"*/city_id={c}/*.parquet"))) for c in ("hot", "small")}
    assert files["hot"] > 3 and files["small"] == 1
    assert read_landed(spark, str(tmp_path / "land"), LANDED).count() == 200_000


# Quarantine


def observations(spark, n, bad):
    schema = "city_id string, latitude double, longitude double, observed_at_utc timestamp_ntz, relative_humidity_2m_pct double, observation_date date"
    day = date(2025, 3, 20)
    rows = [
        ("oslo", 59.9, 10.7, datetime(2025, 3, 20, i % 24), 250.0 if i < bad else 50.0, day)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schema)


def test_gate_accepts_few_rejects(spark, contract):
    gated = gate(observations(spark, 200, 1), contract, ["city_id", "observation_date"])
    report = gated.report.first()
    assert (report.total_rows, report.accepted_rows, report.rejected_rows) == (200, 199, 1)
    assert report.passed and gated.accepted.count() == 199 and gated.rejected.count() == 1


def test_gate_refuses_many_rejects(spark, contract):
    rows = observations(spark, 10, 2)
    gated = gate(rows, contract, ["city_id", "observation_date"])
    assert not gated.report.first().passed
    assert gated.accepted.count() == 0 and gated.rejected.count() == 2
    with pytest.raises(Exception, match=r"oslo 2025-03-20: 2 of 10 rows rejected \(20.0%, limit 2.0%\) by weather_observation v1"):
        gate(rows, contract, ["city_id", "observation_date"], strict=True)


def test_gate_threshold_and_empty(spark, contract):
    unit = ["city_id", "observation_date"]
    gated = gate(observations(spark, 10, 1), contract, unit, max_reject_ratio=0.5)
    assert gated.report.first().reject_ratio == pytest.approx(0.1)
    assert gated.accepted.count() == 9
    one_of_24 = gate(observations(spark, 24, 1), contract, unit)
    assert not one_of_24.report.first().passed
    exactly = gate(observations(spark, 50, 1), contract, unit)
    assert exactly.report.first().passed  # 2 % is not above 2 %
    empty = gate(observations(spark, 1, 0).limit(0), contract, unit, strict=True)
    assert empty.accepted.count() == 0 and empty.report.count() == 0


def test_gate_without_refusals_does_not_shuffle_rows(spark, contract):
    gated = gate(observations(spark, 200, 1), contract, ["city_id", "observation_date"])
    plan = gated.accepted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_quarantine_roundtrip_and_clean_rerun(spark, contract, tmp_path):
    path, unit = str(tmp_path / "q"), ["observation_date", "city_id"]
    assert read_quarantine(spark, path, UNIT_SCHEMA).count() == 0
    at = datetime(2025, 3, 22, tzinfo=UTC)
    rejected = gate(observations(spark, 200, 1), contract, unit).rejected
    units = observations(spark, 1, 0).select(unit)
    write_quarantine(quarantine_lines(rejected, contract, unit, at), path, unit, units)
    row = read_quarantine(spark, path, UNIT_SCHEMA).first()
    assert row["_contract"] == "weather_observation.v1"
    assert row["_quarantined_at_utc"] == at.isoformat()
    assert row["_reasons"] == ["relative_humidity_2m_pct: 250.0 above contract maximum 100.0"]
    assert json.loads(row["row"])["relative_humidity_2m_pct"] == 250.0

    clean = gate(observations(spark, 200, 0), contract, unit).rejected
    write_quarantine(quarantine_lines(clean, contract, unit, at), path, unit, units)
    assert read_quarantine(spark, path, UNIT_SCHEMA).count() == 0
