"""One document per unit, day-and-bucket stores, affected days, joint checks, the daily flow."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablegate.operators.audit import load_state
from tablegate.operators.checks import (
    Check,
    calendar_failures,
    check_accepted_values,
    check_calendar_gaps,
    check_completeness,
    check_reconcile,
    check_relationships,
    check_unique,
    check_unique_combination,
    is_missing,
    keyed_accepted,
    keyed_reconcile,
    keyed_relationship,
    keyed_unique,
    run_checks,
    run_together,
)
from tablegate.operators.incremental import clamp_range, stored_cutoff
from tablegate.plans.catalog import publish_catalog
from tablegate.plans.daily import run_daily
from tablegate.plans.ingest import raw_schema
from tablegate.plans.marts import build_marts, rebuild_units, stage_cities, stage_observations
from tablegate.sources.landing import land_units, read_landed
from tablegate.sources.payloads import latest_documents, read_payloads
from tablegate.sources.publish import read_table, replace_partitions
from tests.conftest import make_payload
from tests.test_flows import day, payload_frame, site, weather  # noqa: F401
from tests.test_sources import LANDED

UNIT = ["observation_date", "city_id"]


def deliveries(spark, *rows):
    return spark.createDataFrame(rows, "observation_date date, city_id string, payload string, delivered int")


def warm(value, hours=24):
    return make_payload(temperature_2m=[value] * 24, hours=24) if hours == 24 else make_payload(
        temperature_2m=[value] * hours, hours=hours
    )


def test_one_whole_document_of_a_unit(site):  # noqa: F811
    """Not the hours of one document and the values of another."""
    spark, d = site.spark, day(20)
    mixed = make_payload(temperature_2m=[1.0] * 12 + [9.0] * 12)
    frame = deliveries(spark, (d, "oslo", mixed, 1), (d, "oslo", warm(5.0), 2), (d, "oslo", mixed, 0), (d, "lima", mixed, 1))
    from tablegate.plans.ingest import ingest_units

    results = ingest_units(
        spark, frame, site.catalogue, site.contract, site.store, "r1", delivered=["delivered"]
    ).collect()
    assert sorted((r.city_id, r.rows_fetched, r.rows_inserted) for r in results) == [("lima", 24, 24), ("oslo", 24, 24)]
    assert {r.temperature_2m_c for r in site.raw.filter("city_id = 'oslo'").collect()} == {5.0}
    assert site.audit.groupBy("city_id").count().filter("count > 1").count() == 0


def test_latest_documents(spark):
    d = day(20)
    frame = deliveries(spark, (d, "a", "x", 1), (d, "a", "y", 1), (d, "a", None, 1), (d, "b", None, None), (d, "c", "z", None), (d, "c", "k", 0))
    got = {r.city_id: r.payload for r in latest_documents(frame, UNIT, ["delivered"]).collect()}
    assert got == {"a": "y", "b": None, "c": "k"}
    single = frame.filter("city_id = 'b'")
    plan = latest_documents(single, UNIT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_delivery_time_of_files(spark, tmp_path):
    folder = tmp_path / "observation_date=2025-03-20" / "city_id=oslo"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("{}")
    rows = read_payloads(spark, str(tmp_path), delivered="delivered")
    assert rows.columns[:1] == ["payload"] and rows.first()["delivered"].year >= 2025


def landed_rows(spark, *units):
    rows = [(float(i), f"b-{c}", h, d, c) for d, c, n, h in units for i in range(n)]
    return spark.createDataFrame(rows, LANDED)


def test_units_share_a_partition(spark, tmp_path):
    path, d1, d2 = str(tmp_path / "land"), day(20), day(21)
    cities = [f"c{i}" for i in range(40)]
    rows = landed_rows(spark, *((d, c, 3, "h1") for d in (d1, d2) for c in cities))
    land_units(rows, path, UNIT, rows.select(UNIT).distinct(), buckets=3)
    folders = {p.parent for p in (tmp_path / "land").rglob("*.parquet")}
    assert len(folders) == 6  # days times buckets, whatever the number of units
    again = landed_rows(spark, (d1, "c1", 2, "h2"), (d1, "c2", 1, "h2"))
    gone = spark.createDataFrame([(d1, "c1"), (d1, "c2"), (d1, "c3")], "observation_date date, city_id string")
    land_units(again, path, UNIT, gone, buckets=3)
    found = {(r.observation_date, r.city_id): r["count"] for r in read_landed(spark, path, LANDED).groupBy(UNIT).count().collect()}
    expected = {(d, c): 3 for d in (d1, d2) for c in cities} | {(d1, "c1"): 2, (d1, "c2"): 1}
    del expected[d1, "c3"]
    assert found == expected
    # All units of a bucket gone: its folder goes, too.
    every = spark.createDataFrame([(d1, c) for c in cities], "observation_date date, city_id string")
    land_units(rows.limit(0), path, UNIT, every, buckets=3)
    assert {r.observation_date for r in read_landed(spark, path, LANDED).collect()} == {d2}


def test_unplanned_and_failing_units_are_seen(site, monkeypatch):  # noqa: F811
    plan = site.catalogue.filter("city_id = 'oslo'").select("city_id", F.lit(day(20)).alias("observation_date"))
    found = site.ingest(weather(days=(20,)), plan=plan)
    assert found["oslo", day(20)].status == "loaded"
    assert {found[c, day(20)].error_message for c in ("lima", "porto")} == {"unit was not planned"}

    def broken(*args, **kwargs):
        raise RuntimeError("disk full")

    monkeypatch.setattr("tablegate.plans.ingest.land_units", broken)
    with pytest.raises(RuntimeError, match="disk full"):
        site.ingest(weather(days=(21,)), "r2")
    rows = site.audit.filter("run_id = 'r2'").collect()
    assert len(rows) == 3 and {(r.status, r.error_message) for r in rows} == {("failed", "disk full")}


def test_a_payload_that_comes_back_is_loaded_again(site):  # noqa: F811
    key = ("oslo", day(20))
    for number, (value, status) in enumerate([(1.0, "loaded"), (2.0, "loaded"), (1.0, "loaded"), (1.0, "skipped_unchanged")]):
        found = site.ingest({key: warm(value)}, f"r{number}", started_at=datetime(2025, 4, 1 + number))
        assert found[key].status == status
        assert {r.temperature_2m_c for r in site.raw.collect()} == {value}
    state = load_state(site.audit).collect()
    assert len(state) == 1 and state[0].observation_date == day(20)
    assert len(list((site.spark._jvm.java.io.File(site.store.audit)).list())) >= 1
    assert site.audit.columns[-1] == "observation_date"  # stored by day


def test_rebuild_of_days_far_apart(site):  # noqa: F811
    site.ingest(weather(days=(3, 10, 20)))
    build_marts(site.spark, site.raw, site.catalogue, site.store.marts)
    fact = f"{site.store.marts}/fct_weather_hourly"
    changed = weather(days=(3, 10, 20), temperature_2m=[5.0] * 24)
    site.ingest(changed, "r2")
    units = site.spark.createDataFrame([(day(3), "oslo"), (day(20), "lima"), (day(20), "lima")], "observation_date date, city_id string")
    files = {p for p in __import__("pathlib").Path(fact).rglob("*.parquet") if "03-10" in str(p)}
    marts = rebuild_units(site.spark, site.raw, site.catalogue, site.store.marts, units)
    warm_units = {(r.city_id, r.observation_date) for r in marts["agg_weather_daily"].filter("avg_temperature_c = 5").collect()}
    assert warm_units == {("oslo", day(3)), ("lima", day(20))}
    assert files == {p for p in __import__("pathlib").Path(fact).rglob("*.parquet") if "03-10" in str(p)}
    assert marts["fct_weather_hourly"].filter("temperature_c = 5").count() == 48
    assert rebuild_units(site.spark, site.raw, site.catalogue, site.store.marts, units.limit(0))["agg_weather_daily"].count() == 9


def test_cutoff_from_folder_names(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored_cutoff(spark, path, "day") < date(1900, 1, 1)
    replace_partitions(spark.createDataFrame([(1, day(20)), (2, day(9))], "k int, day date"), path, ["day"])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("cutoff", "")
    assert stored_cutoff(spark, path, "day") == day(13)
    assert list(tracker.getJobIdsForGroup("cutoff")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_inverted_request(site):  # noqa: F811
    with pytest.raises(ValueError, match="inverted range"):
        clamp_range(day(21), day(20), day(30), 2)


@pytest.mark.parametrize("seed", range(3))
def test_joint_checks_count_what_single_checks_find(spark, seed):
    rng = random.Random(seed)
    days = [date(2025, 3, d) for d in range(1, 12)]
    fact = [(rng.choice(["a", "b", "c", "x", None]), rng.choice([*days, None]), rng.randint(0, 9)) for _ in range(120)]
    stated = {}
    for city, d, _ in fact:
        if rng.random() < 0.9:
            stated[city, d] = stated.get((city, d), 0) + 1
    daily = [(c, d, rng.choice([n, n, 24])) for (c, d), n in stated.items()] + [("z", days[0], 1)]
    facts = spark.createDataFrame(fact, "city_id string, day date, v int")
    dailies = spark.createDataFrame(daily, "city_id string, day date, hours_observed long")
    parents = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "city_id string")
    keys = ["city_id", "day"]
    single = [
        Check("unique", failing=check_unique(parents, "city_id")),
        Check("combination", failing=check_unique_combination(facts, ["city_id", "day", "v"])),
        Check("accepted", failing=check_accepted_values(facts, "v", [1, 2, 3])),
        Check("parents", failing=check_relationships(facts, "city_id", parents, "city_id")),
        Check("missing", facts, is_missing("city_id"), severity="warn"),
        Check("reconcile", failing=check_reconcile(facts, dailies, keys)),
        Check("complete", failing=check_completeness(dailies, "day"), severity="warn"),
        Check("gaps", failing=check_calendar_gaps(dailies, "city_id", "day")),
    ]
    incomplete, gaps = calendar_failures(dailies, "city_id", "day")
    joint = [
        keyed_unique("unique", parents, ["city_id"], nulls=False),
        keyed_unique("combination", facts, ["city_id", "day", "v"]),
        keyed_accepted("accepted", facts, "v", [1, 2, 3]),
        keyed_relationship("parents", facts, "city_id", parents, "city_id"),
        Check("missing", facts, is_missing("city_id"), severity="warn"),
        keyed_reconcile("reconcile", facts, dailies, keys),
        Check("complete", failing=incomplete, severity="warn", counted=True),
        Check("gaps", failing=gaps, counted=True),
    ]
    got, expected = run_together(joint), run_checks(single)
    # A null key equals no other one in the single check's join.
    loose = {"reconcile"}
    found = {r.check: (r.severity, r.failures, r.status) for r in got.collect()}
    wanted = {r.check: (r.severity, r.failures, r.status) for r in expected.collect()}
    assert {k: v for k, v in found.items() if k not in loose} == {k: v for k, v in wanted.items() if k not in loose}
    own = {}
    for city, d, _ in fact:
        own[city, d] = own.get((city, d), 0) + 1
    told = {(c, d): n for c, d, n in daily}
    assert found["reconcile"][1] == sum(own.get(k) != told.get(k) for k in own.keys() | told.keys())


def test_joint_checks_scan_each_table_once(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(20).withColumn("v", F.col("id") % 3).write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("a", "b"))
    checks = [
        keyed_unique("ids", a, ["id"]), keyed_unique("pairs", a, ["id", "v"]), keyed_accepted("v", a, "v", [0, 1]),
        Check("missing", a, is_missing("v")), keyed_relationship("parents", a, "v", b, "v"),
        keyed_reconcile("sums", a, b, ["id"], "v"), Check("b", b, is_missing("v")),
    ]
    result = run_together(checks)
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert {r.check: r.failures for r in result.collect()}["v"] == 1


def test_daily_flow_stops_at_a_stale_source(site):  # noqa: F811
    frame = payload_frame(site.spark, weather(days=(20, 21)))
    args = (site.spark, frame, site.catalogue, site.contract, site.store, "r1", day(20), day(21))
    options = {"started_at": datetime(2025, 3, 23, 6)}
    late = run_daily(*args, datetime(2025, 3, 25, 7), options).collect()
    assert [(r.step, r.status) for r in late] == [("ingest", "pass"), ("freshness", "error"), ("marts", "not run"), ("tests", "not run")]
    assert read_table(site.spark, f"{site.store.marts}/fct_weather_hourly") is None
    tired = run_daily(*args, datetime(2025, 3, 24, 13), options).collect()
    assert [(r.step, r.status) for r in tired] == [("ingest", "pass"), ("freshness", "warn"), ("marts", "pass"), ("tests", "pass")]
    assert read_table(site.spark, f"{site.store.marts}/fct_weather_hourly").count() == 144


def test_freshness_limits_come_from_the_contract(contract):
    from dataclasses import replace

    assert (contract.freshness_warn_hours, contract.freshness_error_hours) == (30, 48)
    assert replace(contract, freshness_error_hours=5).freshness_error_hours == 5


def test_catalog(site):  # noqa: F811
    site.ingest(weather(days=(20, 21)))
    build_marts(site.spark, site.raw, site.catalogue, site.store.marts)
    cities = f"{site.store.root}/cities"
    site.catalogue.write.parquet(cities)
    names = publish_catalog(site.spark, "weather_test", site.store.raw, cities, site.store.marts)
    assert set(names) == {
        "weather_observation", "city_catalogue", "dim_city", "fct_weather_hourly", "agg_weather_daily",
        "stg_weather__observations", "stg_weather__cities",
    }
    staged = stage_observations(site.raw)
    by_name = site.spark.table("weather_test.stg_weather__observations").select(staged.columns)
    assert sorted(map(str, by_name.collect())) == sorted(map(str, staged.collect()))
    named = site.spark.table("weather_test.stg_weather__cities")
    assert sorted(map(str, named.collect())) == sorted(map(str, stage_cities(site.catalogue).collect()))
    # After another run the same names show the new days.
    site.ingest(weather(days=(20, 21, 22)), "r2")
    build_marts(site.spark, site.raw, site.catalogue, site.store.marts)
    publish_catalog(site.spark, "weather_test", site.store.raw, cities, site.store.marts)
    assert site.spark.table("weather_test.fct_weather_hourly").filter("observation_date = date'2025-03-22'").count() == 72
    assert site.spark.table("weather_test.dim_city").filter("observation_count = 72").count() == 3
    assert raw_schema(site.contract).names[-1] == "observation_date"
    site.spark.sql("DROP DATABASE weather_test CASCADE")
