"""Declared schemas and the column-name styles the sources meet."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """StructType from ``name type`` pairs separated by commas; needs no session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Field names and types of the published record layouts.
RAW_TRIP = _struct(
    "vendor_id int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count int, trip_distance double, rate_code_id int, store_and_fwd_flag string, "
    "pu_location_id int, do_location_id int, payment_type int, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double"
)
ANALYTICS_TRIP = _struct(
    "trip_id string, pickup_datetime timestamp, dropoff_datetime timestamp, pickup_date date, "
    "pickup_hour int, pickup_day int, pickup_month int, pickup_year int, pickup_dayofweek int, "
    "trip_duration_minutes double, trip_distance double, speed_mph double, passenger_count int, "
    "fare_amount double, tip_amount double, total_amount double, cost_per_mile double, "
    "cost_per_minute double, tip_percentage double, trip_distance_category string, "
    "time_of_day string, is_weekend boolean, is_rush_hour boolean, payment_type string, "
    "pickup_location_id int, dropoff_location_id int"
)
SAMPLE_TRIP = _struct(
    "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int, "
    "dropoff_location_id int, passenger_count int, trip_distance double, fare_amount double, "
    "tip_amount double, total_amount double, payment_type string, trip_type string, "
    "tip_percentage double, cost_per_mile double, trip_duration_minutes double, speed_mph double, "
    "pickup_hour int, pickup_dayofweek string, is_weekend boolean, time_of_day string, "
    "trip_distance_category string"
)
WAREHOUSE_TRIP = _struct(
    "vendor_id string, pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count int, "
    "trip_distance double, pickup_location_id string, dropoff_location_id string, "
    "payment_type string, fare_amount double, total_amount double"
)
ZONE = _struct("LocationID int, Borough string, Zone string")

# Analytics-style name for each raw-style name.
RAW_TO_ANALYTICS = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "pu_location_id": "pickup_location_id",
    "do_location_id": "dropoff_location_id",
    "distance_category": "trip_distance_category",
}

# Spellings found in published files, lower case, and the raw-style name.
SOURCE_SPELLINGS = {
    "vendorid": "vendor_id",
    "ratecodeid": "rate_code_id",
    "pulocationid": "pu_location_id",
    "dolocationid": "do_location_id",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "pickup_location_id": "pu_location_id",
    "dropoff_location_id": "do_location_id",
}
