from __future__ import annotations

import json
import math
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablegate.operators.once import computed_once
from tablegate.operators.validate import flagged, reasons, split_valid, unknown_fields, validate
from tablegate.sources.contract import Contract, ContractError, FieldSpec

SCHEMA = (
    "city_id string, latitude double, longitude double, observed_at_utc timestamp_ntz, "
    "temperature_2m_c double, relative_humidity_2m_pct double, precipitation_mm double, "
    "wind_speed_10m_kmh double, weather_code int"
)
VALID = {
    "city_id": "lima",
    "latitude": -12.05,
    "longitude": -77.04,
    "observed_at_utc": datetime(2025, 3, 4, 17),
    "temperature_2m_c": 26.75,
    "relative_humidity_2m_pct": 81.5,
    "precipitation_mm": 0.3,
    "wind_speed_10m_kmh": 14.25,
    "weather_code": 51,
}


def check(spark, contract, **changes):
    row = VALID | changes
    df = spark.createDataFrame([tuple(row[k] for k in VALID)], SCHEMA)
    return list(validate(df, contract).first()["_reasons"])


def check_json(spark, contract, **changes):
    row = VALID | {"observed_at_utc": "2025-03-04T17:00"} | changes
    df = spark.createDataFrame([(json.dumps(row),)], "text string").select(
        F.parse_json("text").alias("doc")
    )
    checked = validate(df, contract, document="doc")
    found = list(checked.first()["_reasons"])
    assert flagged(df, contract, "doc").first()["_rejected"] == bool(found)
    return found


def test_load(contract):
    assert contract.primary_key == ("city_id", "observed_at_utc")
    assert contract.source_lag_days == 2
    assert contract.id == "weather_observation.v1"
    assert contract.to_struct()["weather_code"].dataType.simpleString() == "bigint"


def test_missing_file():
    with pytest.raises(ContractError, match="not found"):
        Contract.load("weather_observation", 99)


def test_malformed(tmp_path):
    base = {
        "name": "x", "version": 1, "grain": "row", "primary_key": ["a"], "partition_key": "d",
        "sla": {"source_lag_days": 0}, "fields": [{"name": "a", "type": "string"}],
    }
    assert Contract.from_document(base).unknown_field_action == "warn_and_keep"
    with pytest.raises(ContractError, match="malformed"):
        Contract.from_document({k: v for k, v in base.items() if k != "grain"})
    with pytest.raises(ContractError, match="unknown keys"):
        Contract.from_document(base | {"fields": [{"name": "a", "type": "string", "unit": "C"}]})
    (tmp_path / "x.v1.yml").write_text("fields: [")
    with pytest.raises(ContractError, match="malformed"):
        Contract.load("x", 1, tmp_path)


def test_valid_row(spark, contract):
    assert check(spark, contract) == []
    assert check_json(spark, contract) == []


def test_null_required_and_optional(spark, contract):
    assert check(spark, contract, city_id=None) == ["city_id: required field is null"]
    assert check(spark, contract, temperature_2m_c=None) == []
    assert check_json(spark, contract, city_id=None) == ["city_id: required field is null"]
    assert check_json(spark, contract, temperature_2m_c=None) == []


def test_out_of_range(spark, contract):
    expected = ["relative_humidity_2m_pct: 100.5 above contract maximum 100.0"]
    assert check(spark, contract, relative_humidity_2m_pct=100.5) == expected
    assert check_json(spark, contract, relative_humidity_2m_pct=100.5) == expected
    assert check(spark, contract, latitude=-91.5, precipitation_mm=1e20) == [
        "latitude: -91.5 below contract minimum -90.0",
        "precipitation_mm: 1e+20 above contract maximum 500.0",
    ]


def test_bounds_are_inclusive(spark, contract):
    assert check(spark, contract, latitude=90.0, relative_humidity_2m_pct=0.0) == []


def test_nan_is_refused_once(spark, contract):
    found = check(spark, contract, temperature_2m_c=math.nan)
    assert found == ["temperature_2m_c: nan is not a number in the contract range"]


def test_types_in_json(spark, contract):
    assert check_json(spark, contract, temperature_2m_c="26.75") == [
        "temperature_2m_c: expected float, got str"
    ]
    assert check_json(spark, contract, temperature_2m_c=True) == [
        "temperature_2m_c: expected float, got boolean"
    ]
    assert check_json(spark, contract, temperature_2m_c=26) == []
    assert check_json(spark, contract, weather_code=51.5) == [
        "weather_code: expected integer, got float"
    ]
    assert check_json(spark, contract, weather_code=[51]) == [
        "weather_code: expected integer, got list"
    ]
    assert check_json(spark, contract, city_id={"a": 1}) == ["city_id: expected string, got dict"]
    assert check_json(spark, contract, observed_at_utc="noon") == [
        "observed_at_utc: expected timestamp, got str"
    ]
    assert check_json(spark, contract, precipitation_mm=501) == [
        "precipitation_mm: 501 above contract maximum 500.0"
    ]


def test_types_of_columns(spark, contract):
    df = spark.createDataFrame([("oslo", "1.5"), ("oslo", None)], "city_id string, v string")
    rules = FieldSpec("v", "float").rules(F.col("v"), df.schema["v"].dataType)
    rows = df.select(rules[0].failed.alias("f"), rules[0].message.alias("m")).collect()
    assert [(r.f, r.m) for r in rows] == [
        (True, "v: expected float, got str"),
        (False, "v: expected float, got str"),
    ]


def test_boolean_field_with_bounds(spark):
    df = spark.createDataFrame([(True,), (False,)], "b boolean")
    rules = FieldSpec("b", "boolean", min=1).rules(F.col("b"), df.schema["b"].dataType)
    found = [r.m for r in df.filter(rules[-1].failed).select(rules[-1].message.alias("m")).collect()]
    assert found == ["b: False below contract minimum 1"]


def test_unknown_type_only_fails_on_a_value(spark):
    contract = Contract("x", 1, (FieldSpec("g", "geography"),))
    empty = spark.createDataFrame([(None,)], "g string")
    assert validate(empty, contract).first()["_reasons"] == []
    with pytest.raises(PySparkException, match="unknown type 'geography'"):
        validate(spark.createDataFrame([("POINT(0 0)",)], "g string"), contract).collect()


def test_split(spark, contract):
    rows = [tuple(VALID.values()), tuple((VALID | {"latitude": -90.25}).values())]
    accepted, rejected = split_valid(spark.createDataFrame(rows, SCHEMA), contract)
    assert accepted.count() == 1
    assert "latitude" in rejected.first()["_reasons"][0]


def test_absent_column(spark, contract):
    df = spark.createDataFrame([("oslo",)], "city_id string")
    found = validate(df, contract).first()["_reasons"]
    assert found == [f"{c}: required field is null" for c in ("latitude", "longitude", "observed_at_utc")]


def test_unknown_fields(spark, contract):
    texts = [json.dumps({"city_id": "oslo", "soil_ph": 6.5, "_note": 1}), '{"city_id": "oslo"}']
    df = spark.createDataFrame([(1, t) for t in texts], "unit int, text string").select(
        "unit", F.parse_json("text").alias("doc")
    )
    rows = unknown_fields(df, contract, "doc", ["unit"]).collect()
    assert [tuple(r) for r in rows] == [(1, "soil_ph", 1)]


def test_unknown_fields_rejected(spark):
    contract = Contract("x", 1, (FieldSpec("a", "integer"),), unknown_field_action="reject")
    df = spark.createDataFrame([('{"a": 1, "z": 2, "b": 3}',), ('{"a": 1}',)], "text string").select(
        F.parse_json("text").alias("doc")
    )
    found = [r["_reasons"] for r in validate(df, contract, "doc").collect()]
    assert found == [["unknown fields not allowed by contract: ['b', 'z']"], []]
    columns = spark.createDataFrame([(1, 2)], "a int, b int")
    assert columns.select(reasons(columns, contract).alias("r")).first()["r"] == [
        "unknown fields not allowed by contract: ['b']"
    ]


def test_reasons_stay_in_generated_code(spark, contract):
    df = spark.createDataFrame([tuple(VALID.values())], SCHEMA)
    plan = validate(df, contract)._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in plan


def test_variants_are_decoded_once(spark, contract):
    """A filter on the result must not pull the parsing into every rule."""
    df = spark.createDataFrame([("{}",)], "text string")
    df = computed_once(df, {"doc": F.try_parse_json("text")})
    rejected = split_valid(df, contract, "doc")[1]
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    assert plan.count("schemaOfVariant") <= len(contract.fields)


def test_filters_pass_a_computed_column(spark, tmp_path):
    spark.createDataFrame([(1, "{}")], "k int, text string").write.parquet(str(tmp_path / "t"))
    df = computed_once(spark.read.parquet(str(tmp_path / "t")), {"doc": F.try_parse_json("text")})
    assert df.filter("k = 1").filter(F.col("doc").isNotNull()).count() == 1
    plan = df.filter("k = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,1)" in plan
