"""Derived trip columns: time, distance and cost features under a profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import columns as C
from tripmill.functions import profiles as P
from tripmill.functions.profiles import Profile


def parse_timestamps(df: DataFrame, profile: Profile = P.V2) -> DataFrame:
    """Pickup and dropoff text to timestamps; text that does not parse gives null."""
    types = dict(df.dtypes)
    parsed = {
        name: F.try_to_timestamp(F.col(name))
        for name in (profile.pickup, profile.dropoff)
        if types.get(name) == "string"
    }
    return df.withColumns(parsed) if parsed else df


def _maybe_round(value: Column, profile: Profile) -> Column:
    return F.round(value, 2) if profile.rounded else value


def calendar_columns(pickup: str) -> dict[str, Column]:
    when = F.col(pickup)
    return {
        "pickup_date": F.to_date(when),
        "pickup_hour": F.hour(when),
        "pickup_day": F.dayofmonth(when),
        "pickup_month": F.month(when),
        "pickup_year": F.year(when),
        "pickup_dayofweek": F.dayofweek(when),
    }


def time_features(df: DataFrame, profile: Profile) -> DataFrame:
    """Calendar parts, duration, weekend flag and hour band."""
    weekend = C.on_weekend(profile.pickup)
    minutes = C.minutes_between(profile.pickup, profile.dropoff, whole_seconds=profile.rounded)
    return df.withColumns(calendar_columns(profile.pickup)).withColumns(
        {
            "trip_duration_minutes": _maybe_round(minutes, profile),
            "is_weekend": weekend.cast("int") if profile.numeric_flags else weekend,
            "time_of_day": C.bin_cut("pickup_hour", P.TIME_BANDS[profile.time_bands]),
        }
    )


def _ratio(profile: Profile, name: str, over, under, scale: float = 1) -> Column:
    rule = "positive" if name in profile.positive_only else profile.on_zero
    return _maybe_round(C.ratio(over, under, rule, scale), profile)


def distance_features(df: DataFrame, profile: Profile) -> DataFrame:
    hours = F.col("trip_duration_minutes") / 60
    derived = {
        "speed_mph": _ratio(profile, "speed_mph", "trip_distance", hours),
        profile.distance_label: C.bin_cut("trip_distance", profile.distance_bands, profile.distance_floor),
    }
    if profile.numeric_flags:
        derived["is_long_trip"] = F.coalesce(F.col("trip_distance") > P.LONG_TRIP_MILES, F.lit(False)).cast("int")
    else:
        derived["is_rush_hour"] = F.col("time_of_day").isin(*P.RUSH_LABELS)
    return df.withColumns(derived)


def cost_features(df: DataFrame, profile: Profile) -> DataFrame:
    derived = {
        "cost_per_mile": _ratio(profile, "cost_per_mile", "total_amount", "trip_distance"),
        "cost_per_minute": _ratio(profile, "cost_per_minute", "total_amount", "trip_duration_minutes"),
        "tip_percentage": _ratio(profile, "tip_percentage", "tip_amount", "fare_amount", 100),
    }
    if profile.numeric_flags:
        derived["payment_type_desc"] = C.lookup("payment_type", P.PAYMENT_LABELS, P.PAYMENT_UNKNOWN)
    return df.withColumns(derived)


def add_features(df: DataFrame, profile: Profile) -> DataFrame:
    """All derived columns of a profile, in three dependent projections."""
    for layer in (parse_timestamps, time_features, distance_features, cost_features):
        df = layer(df, profile)
    return df


def zone_features(df: DataFrame, profile: Profile = P.V4) -> DataFrame:
    """Feature set of the zone-enriched table: time features and cost per minute."""
    timed = time_features(df, profile)
    return timed.withColumns(
        {"cost_per_minute": _ratio(profile, "cost_per_minute", "total_amount", "trip_duration_minutes")}
    )
