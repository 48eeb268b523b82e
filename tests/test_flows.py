from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablegate.operators.audit import AUDIT_SCHEMA
from tablegate.operators.checks import run_checks
from tablegate.operators.validate import DataQualityError
from tablegate.plans.data_tests import weather_checks
from tablegate.plans.ingest import UNIT, Store, ingest_range, ingest_units, raw_schema
from tablegate.plans.marts import build_marts, coverage, rebuild_marts, stage_observations
from tablegate.session import read_if_exists
from tablegate.sources.landing import landed_hashes, read_landed
from tablegate.sources.quarantine import read_quarantine
from tests.conftest import make_payload
from tests.test_sources import UNIT_SCHEMA

AS_OF = date(2025, 4, 1)


def payload_frame(spark, units):
    rows = [(day, city, text) for (city, day), text in units.items()]
    return spark.createDataFrame(rows, "observation_date date, city_id string, payload string")


def day(n):
    return date(2025, 3, n)


def weather(cities=("oslo", "lima", "porto"), days=(20, 21), **changes):
    return {(c, day(n)): make_payload(day(n).isoformat(), **changes) for c in cities for n in days}


class Site:
    def __init__(self, spark, catalogue, contract, root):
        self.spark, self.catalogue, self.contract = spark, catalogue, contract
        self.store = Store(str(root))

    def ingest(self, units, run_id="r1", **options):
        results = ingest_units(
            self.spark, payload_frame(self.spark, units), self.catalogue, self.contract, self.store, run_id, **options
        )
        return {(r.city_id, r.observation_date): r for r in results.collect()}

    @property
    def raw(self):
        return self.spark.read.schema(raw_schema(self.contract)).parquet(self.store.raw)

    @property
    def audit(self):
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.store.audit)


@pytest.fixture
def site(spark, catalogue, contract, tmp_path):
    return Site(spark, catalogue, contract, tmp_path)


def test_first_run_loads_and_second_skips(site):
    first = site.ingest(weather())
    assert {(r.status, r.rows_inserted, r.rows_updated) for r in first.values()} == {("loaded", 24, 0)}
    assert site.raw.count() == 144
    second = site.ingest(weather(), "r2")
    assert {(r.status, r.rows_inserted, r.rows_updated) for r in second.values()} == {
        ("skipped_unchanged", 0, 0)
    }
    assert site.raw.count() == 144
    assert {r["count"] for r in site.audit.groupBy("run_id", "status").count().collect()} == {6}


def test_restated_unit_updates_its_rows_only(site):
    site.ingest(weather())
    units = weather()
    units[("oslo", day(20))] = make_payload(temperature_2m=[1.0] * 24)
    found = site.ingest(units, "r2")
    changed = found.pop(("oslo", day(20)))
    assert (changed.status, changed.rows_inserted, changed.rows_updated) == ("loaded", 0, 24)
    assert {r.status for r in found.values()} == {"skipped_unchanged"}
    assert site.raw.count() == 144 and site.raw.filter("temperature_2m_c = 1").count() == 24


def test_landing_is_one_partition_per_unit(site):
    site.ingest(weather())
    schema = raw_schema(site.contract)
    landed = read_landed(site.spark, site.store.landing, schema)
    assert landed.count() == 144
    hashes = landed_hashes(landed, UNIT).collect()
    assert len(hashes) == 6 and all(len(r["_source_payload_hash"]) == 64 for r in hashes)


def test_failing_units_do_not_stop_others(site):
    units = weather(days=(20,))
    units[("oslo", day(20))] = make_payload(relative_humidity_2m=[250.0, 250.0] + [50.0] * 22)
    units[("lima", day(20))] = make_payload(temperature_2m=[1.0])
    plan = site.catalogue.select("city_id", F.explode(F.array(F.lit(day(20)), F.lit(day(21)))).alias("observation_date"))
    found = site.ingest(units, plan=plan)
    bad = found[("oslo", day(20))]
    assert bad.status == "failed" and bad.rows_rejected == 2 and bad.rows_accepted == 0
    assert bad.error_message == (
        "oslo 2025-03-20: 2 of 24 rows rejected (8.3%, limit 2.0%) by weather_observation v1"
    )
    assert found[("lima", day(20))].error_message.startswith("lima: series 'temperature_2m' holds 1")
    assert found[("porto", day(20))].status == "loaded"
    assert {found[(c, day(21))].error_message for c in ("oslo", "lima", "porto")} == {
        "producer returned no rows"
    }
    assert site.raw.select("city_id").distinct().collect()[0][0] == "porto"
    assert site.audit.filter("status = 'failed'").count() == 5
    lines = read_quarantine(site.spark, site.store.quarantine, UNIT_SCHEMA).collect()
    assert len(lines) == 2 and "250" in lines[0]["row"] and lines[0].city_id == "oslo"

    # The repaired unit clears its quarantine.
    repaired = site.ingest(weather(cities=("oslo",), days=(20,)), "r2")
    assert repaired[("oslo", day(20))].status == "loaded"
    assert read_quarantine(site.spark, site.store.quarantine, UNIT_SCHEMA).count() == 0


def test_unknown_city_is_a_failed_unit(site):
    units = dict(list(weather().items())[:1])
    (known, document), = units.items()
    got = site.ingest({**units, ("atlantis", known[1]): document})
    assert got[known].status == "loaded"
    lost = got["atlantis", known[1]]
    assert (lost.status, lost.error_message, lost.rows_inserted) == ("failed", "unknown city", 0)


def test_threshold_lets_a_unit_through(site):
    units = weather(cities=("oslo",), days=(20,))
    units[("oslo", day(20))] = make_payload(relative_humidity_2m=[250.0] + [50.0] * 23)
    row = site.ingest(units, max_reject_ratio=0.05)[("oslo", day(20))]
    assert (row.status, row.rows_fetched, row.rows_accepted, row.rows_rejected) == ("loaded", 24, 23, 1)
    assert site.raw.count() == 23


def test_full_refresh_repairs_rows_of_an_unchanged_payload(site):
    site.ingest(weather(cities=("oslo",), days=(20,)))
    found = site.ingest(weather(cities=("oslo",), days=(20,)), "r2", full_refresh=True)
    row = found[("oslo", day(20))]
    assert (row.status, row.rows_inserted, row.rows_updated) == ("loaded", 0, 24)


def test_land_only_leaves_no_table(site):
    site.ingest(weather(), land_only=True)
    assert read_if_exists(site.spark, site.store.raw) is None
    assert read_if_exists(site.spark, site.store.audit) is None
    assert read_landed(site.spark, site.store.landing, raw_schema(site.contract)).count() == 144


def test_rows_are_stored_under_their_own_day(site):
    late = {("oslo", day(20)): make_payload(time=[f"2025-03-20T{h:02d}:00-02:00" for h in range(24)])}
    row = site.ingest(late)[("oslo", day(20))]
    assert row.rows_inserted == 24
    found = {r.observation_date: r["count"] for r in site.raw.groupBy("observation_date").count().collect()}
    assert found == {day(20): 22, day(21): 2}


def test_failed_merge_is_audited(site, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("disk full")

    monkeypatch.setattr("tablegate.plans.ingest.upsert", broken)
    with pytest.raises(RuntimeError, match="disk full"):
        site.ingest(weather(cities=("oslo",)))
    rows = site.audit.collect()
    assert {(r.status, r.error_message) for r in rows} == {("failed", "disk full")}


def test_unknown_series_can_be_refused(site):
    from dataclasses import replace

    units = weather(cities=("oslo",), days=(20,), uv_index=[1] * 24, rain=[0] * 24)
    kept = site.ingest(units)[("oslo", day(20))]
    assert (kept.status, kept.unknown_fields) == ("loaded", "rain, uv_index")
    site.contract = replace(site.contract, unknown_field_action="reject")
    row = site.ingest(units, "r2")[("oslo", day(20))]
    assert row.status == "failed"
    assert row.error_message == "unknown fields not allowed by contract: rain, uv_index"


def test_range_clamps_and_sums(site):
    frame = payload_frame(site.spark, weather(days=(20, 21, 22)))
    args = (site.spark, frame, site.catalogue, site.contract, site.store)
    summary = ingest_range(*args, "r1", day(20), day(25), as_of=day(23)).first()
    assert (summary.partitions_attempted, summary.partitions_loaded) == (6, 6)
    assert summary.rows_inserted == 144
    nothing = ingest_range(*args, "r2", day(25), day(25), as_of=day(23)).first()
    assert tuple(nothing) == (0,) * 7
    with pytest.raises(DataQualityError, match="lima 2025-03-23: producer returned no rows"):
        ingest_range(*args, "r3", day(20), day(23), as_of=AS_OF, strict=True)


def test_empty_catalogue(site):
    site.catalogue = site.catalogue.limit(0)
    with pytest.raises(ValueError, match="no city in the catalogue"):
        site.ingest(weather())


# Marts


def snapshot(marts):
    return {
        name: sorted(map(str, marts[name].drop("dbt_updated_at").collect()))
        for name in ("dim_city", "fct_weather_hourly", "agg_weather_daily")
    }


def test_marts(site):
    site.ingest(weather(cities=("oslo", "lima"), precipitation=[0.0, 1.005] * 12, temperature_2m=[-1.0, None] * 12))
    marts = build_marts(site.spark, site.raw, site.catalogue, site.store.marts)
    dim = {r.city_id: r for r in marts["dim_city"].collect()}
    assert (dim["oslo"].observation_count, dim["oslo"].has_observations) == (48, True)
    assert (dim["porto"].observation_count, dim["porto"].has_observations) == (0, False)
    assert (dim["lima"].size_band, dim["porto"].size_band, dim["oslo"].size_band) == ("large", "medium", "small")
    hour = marts["fct_weather_hourly"].filter("city_id = 'oslo'").orderBy("observed_at_utc").collect()
    assert len(hour) == 48
    assert (hour[1].is_wet_hour, hour[1].is_freezing_hour, hour[0].is_freezing_hour) == (True, None, True)
    assert (hour[5].hour_of_day_utc, hour[5].day_of_week_iso) == (5, 4)
    daily = marts["agg_weather_daily"].orderBy("city_id", "observation_date").first()
    assert (daily.hours_observed, daily.is_complete_day, daily.wet_hours) == (24, True, 12)
    assert (daily.freezing_hours, daily.hours_missing_temperature) == (12, 12)
    assert (daily.avg_temperature_c, daily.total_precipitation_mm) == (-1.0, 12.06)
    assert site.spark.table("stg_weather__observations").count() == 96


def test_marts_are_idempotent_and_take_restatements(site):
    site.ingest(weather(days=(10, 19, 20)))
    first = snapshot(build_marts(site.spark, site.raw, site.catalogue, site.store.marts))
    again = build_marts(site.spark, site.raw, site.catalogue, site.store.marts)
    assert snapshot(again) == first
    units = weather(days=(10, 19, 20))
    units[("oslo", day(19))] = make_payload("2025-03-19", temperature_2m=[5.0] * 24)
    units[("oslo", day(10))] = make_payload("2025-03-10", temperature_2m=[5.0] * 24)
    site.ingest(units, "r2")
    daily = build_marts(site.spark, site.raw, site.catalogue, site.store.marts)["agg_weather_daily"]
    warm = {r.observation_date for r in daily.filter("city_id = 'oslo' and avg_temperature_c = 5").collect()}
    assert warm == {day(19)}  # the 10th lies before the window
    marts = rebuild_marts(site.spark, site.raw, site.catalogue, site.store.marts, day(10), day(10))
    warm = {r.observation_date for r in marts["agg_weather_daily"].filter("avg_temperature_c = 5").collect()}
    assert warm == {day(10), day(19)}


def test_staging_drops_null_keys_and_duplicates(site):
    site.ingest(weather(cities=("oslo",), days=(20,)))
    later = site.raw.withColumns({
        "_ingested_at_utc": F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz"),
        "temperature_2m_c": F.lit(7.0),
    })
    keyless = site.raw.withColumn("city_id", F.lit(None).cast("string"))
    both = site.raw.unionByName(later).unionByName(keyless)
    staged = stage_observations(both)
    assert staged.count() == 24 and staged.filter("temperature_c = 7").count() == 24
    assert staged.select("observation_key").distinct().count() == 24
    assert coverage(both).first().observation_count == 24


def test_data_tests(site):
    site.ingest(weather(days=(19, 20, 22)))
    marts = build_marts(site.spark, site.raw, site.catalogue, site.store.marts)
    checks = weather_checks(marts, as_of=datetime(2026, 9, 1))
    assert len(checks) == 40
    found = {r.check: (r.failures, r.status) for r in run_checks(checks).collect()}
    assert len(found) == 40
    assert found.pop("assert_no_missing_days") == (3, "warn")
    assert set(found.values()) == {(0, "pass")}
