from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import by_id
from pyspark.sql import functions as F

from tripmill.operators import clean, quality, zones

NOON = datetime(2023, 3, 1, 12, 0, 0)


def test_passenger_limits(make_trips):
    df = make_trips(*[{"passenger_count": p} for p in (None, 0, 1, 9, 10)])
    assert by_id(clean.clean_trips(df), "passenger_count") == [1, 9]


def test_missing_values_drop(make_trips):
    names = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount", "total_amount")
    df = make_trips({}, *[{n: None} for n in names])
    assert by_id(clean.drop_null_critical(df), "trip_id") == ["0"]


def test_p99_keeps_zero_fare_and_drops_reversed_trips(make_trips):
    rows = [{"trip_distance": 1.0 + i / 100, "total_amount": 5.0 + i / 100} for i in range(200)]
    rows += [{"fare_amount": 0.0, "trip_distance": 1.0, "total_amount": 5.0}]
    rows += [{"tpep_dropoff_datetime": NOON - timedelta(minutes=1), "trip_distance": 1.0, "total_amount": 5.0}]
    kept = by_id(clean.clean_trips_p99(make_trips(*rows)), "trip_id")
    assert "200" in kept and "201" not in kept
    assert "199" not in kept and "0" in kept


def test_reject_reasons_count_each_failure(make_trips):
    df = make_trips({}, {"trip_distance": None}, {"fare_amount": -1.0, "passenger_count": 0})
    counts = {r.reason: r.rejected_rows for r in clean.reject_reasons(df, clean.standard_rules()).collect()}
    assert counts == {
        "trip_distance_missing": 1,
        "distance_out_of_range": 1,
        "fare_not_positive": 1,
        "passengers_out_of_range": 1,
    }


def test_valid_flag_agrees_with_filter(make_trips):
    df = make_trips({}, {"trip_distance": None}, {"passenger_count": None})
    flagged = clean.flag_valid(df, clean.standard_rules())
    assert by_id(flagged, "is_valid") == [True, False, False]


def test_recent_window(spark):
    df = spark.sql("SELECT date'2023-01-31' - id AS pickup_date FROM (SELECT explode(sequence(0, 40)) AS id)")
    assert clean.recent_window(df, F.lit("2023-01-31").cast("date")).count() == 31


def test_gates(make_trips):
    df = make_trips({}, {"tpep_pickup_datetime": None}, {"fare_amount": -2.0})
    counts = quality.dq_counts(df, "tpep_pickup_datetime", "tpep_dropoff_datetime")
    verdicts = {r.check_name: r.passed for r in quality.dq_assertions(counts).collect()}
    assert verdicts == {"null_pickup_count": False, "null_dropoff_count": True, "negative_fare_count": False}
    bounds = {r.check_name: r.passed for r in quality.record_count_bounds(counts).collect()}
    assert bounds == {"min_records": False, "max_records": True}
    with pytest.raises(quality.QualityError, match="null_pickup_count"):
        quality.require(quality.dq_assertions(counts))
    assert quality.min_count_check(df, 3).first().passed
    rate = quality.success_rate(df, clean.standard_rules()).first()
    assert (rate.input_rows, rate.valid_rows, rate.passed) == (3, 1, False)


def test_zone_joins(spark, make_trips):
    lookup = spark.createDataFrame([(1, "North", "A"), (2, "South", "B")], "LocationID int, Borough string, Zone string")
    df = make_trips({}, {"pu_location_id": 9}, {"do_location_id": 9})
    enriched = zones.zone_enrich(df, lookup)
    assert by_id(enriched, "pickup_zone", "dropoff_borough") == [("A", "South")]
    assert [tuple(r) for r in zones.zone_gap_report(df, lookup).collect()] == [(9, 1)]
    rollup = {r.zone_name: (r.trip_count, r.total_revenue, r.avg_fare) for r in zones.zone_rollup(df, lookup).collect()}
    assert rollup == {"A": (2, 24.0, 12.0)}


def test_zone_join_is_broadcast_only_when_checked(spark, make_trips, monkeypatch):
    lookup = spark.range(50).selectExpr("CAST(id AS int) AS LocationID", "'x' AS Borough", "'y' AS Zone")
    df = make_trips({})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = zones.zone_enrich(df, lookup)._jdf.queryExecution().executedPlan().toString()
        assert small.count("BroadcastHashJoin") == 2
        monkeypatch.setattr(zones, "fits_broadcast", lambda _: False)
        large = zones.zone_enrich(df, lookup)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert large.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
