from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmill.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TRIP_FIELDS = (
    "trip_id string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count int, "
    "trip_distance double, pu_location_id int, do_location_id int, payment_type int, fare_amount double, "
    "tip_amount double, total_amount double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture
def make_trips(spark):
    """Trips from partial rows; unnamed fields take the values of an ordinary trip."""

    def make(*rows: dict):
        names = [part.split()[0] for part in TRIP_FIELDS.split(", ")]
        usual = {
            "tpep_pickup_datetime": datetime(2023, 3, 1, 12, 0, 0),
            "tpep_dropoff_datetime": datetime(2023, 3, 1, 12, 30, 0),
            "passenger_count": 1,
            "trip_distance": 3.0,
            "pu_location_id": 1,
            "do_location_id": 2,
            "payment_type": 1,
            "fare_amount": 10.0,
            "tip_amount": 2.0,
            "total_amount": 12.0,
        }
        full = [{"trip_id": str(i), **usual, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(row[n] for n in names) for row in full], TRIP_FIELDS)

    return make


def by_id(df, *columns):
    """Values of the named columns per trip, in trip order."""
    rows = sorted(df.select("trip_id", *columns).collect(), key=lambda r: int(r.trip_id))
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows]
