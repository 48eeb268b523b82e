from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tablegate.session import get_session  # noqa: E402
from tablegate.sources.contract import Contract  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def contract():
    return Contract.load("weather_observation", 1, ROOT / "contracts")


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"


def reading(hour):
    """A showery spring day: warmest at 15:00, rain every sixth hour."""
    rain = hour % 6 == 4
    return {
        "temperature_2m": 11.6 - 0.75 * abs(hour - 15),
        "relative_humidity_2m": 91.0 if rain else 74.0 - hour,
        "precipitation": 1.25 if rain else 0.0,
        "wind_speed_10m": 6.5 + 0.5 * (hour % 8),
        "weather_code": 80 if rain else 2,
    }


def present(values):
    return {name: value for name, value in values.items() if value is not ...}


def make_payload(day="2025-03-20", hours=24, top=None, **series):
    """The readings of a day in Porto, as the producer's columns.

    Keyword arguments replace a column, and ``top`` the fields beside them; ``...`` leaves
    one out.
    """
    table = [{"time": f"{day}T{hour:02d}:00"} | reading(hour) for hour in range(hours)]
    columns = {name: [row[name] for row in table] for name in ("time", *reading(0))}
    place = {"latitude": 41.15, "longitude": -8.61}
    return json.dumps(present({**place, "hourly": present(columns | series), **(top or {})}))


CATALOGUE = """city_id,name,country_code,latitude,longitude,timezone_name,population
oslo,Oslo,NO,59.91,10.75,Europe/Oslo,700000
lima,Lima,PE,-12.05,-77.04,America/Lima,10000000
porto,Porto,PT,41.15,-8.61,Europe/Lisbon,1300000
"""


@pytest.fixture(scope="session")
def catalogue_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("catalogue") / "cities.csv"
    path.write_text(CATALOGUE)
    return str(path)


@pytest.fixture
def catalogue(spark, catalogue_path):
    from tablegate.sources.catalogue import read_catalogue

    return read_catalogue(spark, catalogue_path)
