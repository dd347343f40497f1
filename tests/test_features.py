from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import by_id
from pyspark.sql import functions as F

from tripmill.functions import columns as C
from tripmill.functions import features, profiles
from tripmill.operators import clean
from tripmill.sources.tables import to_analytics_names

NOON = datetime(2023, 3, 1, 12, 0, 0)


def v1(df):
    return features.add_features(df, profiles.V1)


def v2(df, profile=profiles.V2):
    return features.add_features(to_analytics_names(df), profile)


def test_zero_duration(make_trips):
    df = make_trips({"tpep_dropoff_datetime": NOON})
    assert by_id(v1(df), "speed_mph", "cost_per_minute") == [(0.0, 0.0)]
    assert by_id(v2(df), "speed_mph", "cost_per_minute") == [(None, None)]


def test_negative_duration(make_trips):
    df = make_trips({"tpep_dropoff_datetime": NOON - timedelta(minutes=30)})
    assert by_id(v1(df), "trip_duration_minutes", "speed_mph") == [(-30.0, 0.0)]
    assert by_id(v2(df), "speed_mph") == [-6.0]
    assert clean.clean_trips(df).count() == 1


def test_distance_bands(make_trips):
    miles = [0.0, 2.0, 2.01, 5.0, 10.0, 10.01, 99.99, 100.0, None]
    df = make_trips(*[{"trip_distance": m} for m in miles])
    labels = ["short", "short", "medium", "medium", "long", "very_long", "very_long", "very_long", None]
    assert by_id(v1(df), "distance_category") == labels
    assert by_id(v2(df, profiles.LOCAL), "trip_distance_category") == [None, *labels[1:]]
    assert by_id(v1(df), "is_long_trip") == [0, 0, 0, 0, 0, 1, 1, 1, 0]
    assert by_id(clean.clean_trips(df), "trip_distance") == miles[1:7]


def test_zero_fare(make_trips):
    df = make_trips({"fare_amount": 0.0, "tip_amount": 3.0}, {})
    assert by_id(v1(df), "tip_percentage") == [0.0, 20.0]
    assert by_id(v2(df), "tip_percentage") == [None, 20.0]
    assert by_id(clean.clean_trips(df), "trip_id") == ["1"]


def test_payment_labels(make_trips):
    df = make_trips(*[{"payment_type": p} for p in (1, 2, 3, 4, 5, None)])
    assert by_id(v1(df), "payment_type_desc") == ["credit_card", "cash", "no_charge", "dispute", "unknown", "unknown"]


# Expected label per hour, written out hour by hour.
HOURS = {
    "five_v1": ["late_night"] * 6 + ["morning_rush"] * 5 + ["midday"] * 6 + ["evening_rush"] * 4 + ["night"] * 3,
    "five_v2": ["early_morning"] * 7 + ["morning_rush"] * 4 + ["midday"] * 5 + ["evening_rush"] * 4 + ["night"] * 4,
    "four_v4": ["Night"] * 6 + ["Morning Rush"] * 5 + ["Midday"] * 6 + ["Evening Rush"] * 4 + ["Night"] * 3,
    "four_v5": ["NIGHT"] * 7 + ["MORNING"] * 6 + ["AFTERNOON"] * 6 + ["EVENING"] * 5,
}


@pytest.mark.parametrize("bands", sorted(HOURS))
def test_hour_bands(spark, bands):
    hours = spark.range(24).select("id", C.bin_cut("id", profiles.TIME_BANDS[bands]).alias("label")).orderBy("id")
    assert [r.label for r in hours.collect()] == HOURS[bands]


def test_null_hour_has_no_band(spark):
    df = spark.createDataFrame([(None,)], "h int").select(C.bin_cut("h", profiles.FIVE_V2).alias("label"))
    assert df.first().label is None


def test_weekend_over_a_week(make_trips):
    monday = datetime(2023, 3, 6, 9)
    df = make_trips(*[{"tpep_pickup_datetime": monday + timedelta(days=i)} for i in range(7)])
    assert by_id(v2(df), "is_weekend") == [False] * 5 + [True] * 2
    assert by_id(v1(df), "is_weekend") == [0] * 5 + [1] * 2
    assert by_id(v2(df), "pickup_dayofweek") == [2, 3, 4, 5, 6, 7, 1]


def test_local_profile_keeps_fractions(make_trips):
    df = make_trips({"tpep_dropoff_datetime": NOON + timedelta(minutes=7, milliseconds=500)})
    assert by_id(v2(df, profiles.LOCAL), "trip_duration_minutes")[0] == pytest.approx(7 + 0.5 / 60)
    assert by_id(v2(df), "trip_duration_minutes") == [7.0]


def test_unparsable_timestamps_give_null(spark):
    df = spark.createDataFrame([("2023-03-01 10:00:00", "x")], "pickup_datetime string, dropoff_datetime string")
    row = features.parse_timestamps(df).first()
    assert row.pickup_datetime == datetime(2023, 3, 1, 10) and row.dropoff_datetime is None


def test_demand_level_without_spread_is_normal(spark):
    df = spark.createDataFrame([(5,)], "n int").select(C.demand_level("n", F.lit(5.0), F.lit(None)).alias("level"))
    assert df.first().level == "Normal"


def test_landing_names(spark):
    df = spark.createDataFrame([(2023, 1)], "y int, m int").select(
        C.landing_path("y", "m").alias("path"),
        C.dated_file_name(F.lit("a.b.parquet"), F.lit("2024-02-03").cast("date")).alias("dated"),
    )
    assert tuple(df.first()) == ("raw/2023/01/yellow_tripdata_2023-01.parquet", "a.b_20240203.parquet")
