"""Zone enrichment of trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import features
from tripmill.functions.profiles import V4, Profile
from tripmill.operators.sizing import fits_broadcast
from tripmill.sources.publish import Publication, new_run_id

SIDES = (("pu_location_id", "pickup"), ("do_location_id", "dropoff"))


def _named(zones: DataFrame, key: str, prefix: str) -> DataFrame:
    return zones.select(
        F.col("LocationID").cast("int").alias(key),
        F.col("Borough").alias(f"{prefix}_borough"),
        F.col("Zone").alias(f"{prefix}_zone"),
    )


def zone_enrich(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough and zone of both trip ends; trips with an unknown end are dropped."""
    small = fits_broadcast(zones)
    for key, prefix in SIDES:
        named = _named(zones, key, prefix)
        trips = trips.join(F.broadcast(named) if small else named, key)
    return trips


def zone_enrich_features(trips: DataFrame, zones: DataFrame, profile: Profile = V4) -> DataFrame:
    return features.zone_features(zone_enrich(trips, zones), profile)


def zone_gap_report(trips: DataFrame, zones: DataFrame, key: str = "pu_location_id") -> DataFrame:
    """Trips per location id that the lookup does not know.

    Trips are counted per id before the anti join, so the join sees one row per id.
    """
    per_location = trips.groupBy(key).agg(F.count(F.lit(1)).alias("unmatched_trips"))
    known = zones.select(F.col("LocationID").cast("int").alias(key))
    return per_location.join(known, key, "left_anti")


def zone_rollup(trips: DataFrame, zones: DataFrame, key: str = "pu_location_id") -> DataFrame:
    """Trips, revenue and average total per zone.

    Sums are taken per location before the zone join: the shuffle carries one
    row per location instead of every trip, and a hot location costs nothing.
    """
    per_location = trips.groupBy(key).agg(
        F.count(F.lit(1)).alias("_trips"),
        F.count("total_amount").alias("_priced"),
        F.sum("total_amount").alias("_revenue"),
    )
    named = zones.select(F.col("LocationID").cast("int").alias(key), F.col("Zone").alias("zone_name"))
    return (
        per_location.join(named, key)
        .groupBy("zone_name")
        .agg(
            F.sum("_trips").alias("trip_count"),
            F.sum("_revenue").alias("total_revenue"),
            F.try_divide(F.sum("_revenue"), F.sum("_priced")).alias("avg_fare"),
        )
    )


def daily_location_rollup(trips: DataFrame, date: str = "pickup_date", key: str = "pu_location_id") -> DataFrame:
    """Trips and average fare per day and location, a table worth storing."""
    return trips.groupBy(F.col(date).alias("date"), key).agg(
        F.count(F.lit(1)).alias("trip_count"), F.avg("fare_amount").alias("avg_fare")
    )


def changed_parts(tables: Publication, source: str, target: str) -> list[str]:
    """Parts of ``source`` that were published after the part of ``target`` made from them."""
    live = tables.live()
    made = live.where(F.col("table_name") == target).select("part", F.col("version").alias("_made"))
    found = live.where(F.col("table_name") == source).join(made, "part", "left")
    return [row["part"] for row in found.where(F.col("_made").isNull() | (F.col("_made") < F.col("version"))).collect()]  # one row per part


def refresh_daily_rollup(tables: Publication, source: str, partition: Sequence[str], target: str = "daily_rollup") -> list[str]:
    """Bring the stored rollup up to date with its published source; returns the parts that were read.

    The manifest tells which parts changed; only these are read and summed, and
    their sums replace those stored before, in one publication.
    """
    parts = changed_parts(tables, source, target)
    if parts:
        trips = tables.read(source, parts)
        sums = trips.groupBy(*partition, F.col("pickup_date").alias("date"), "pu_location_id").agg(
            F.count(F.lit(1)).alias("trips"), F.count("fare_amount").alias("priced"), F.sum("fare_amount").alias("fares")
        )
        tables.publish([tables.stage(sums, target, new_run_id(), partition)], parts)
    return parts


def stored_daily_rollup(tables: Publication, target: str = "daily_rollup") -> DataFrame:
    """The rollup that :func:`daily_location_rollup` computes, merged from the stored sums of all parts."""
    return tables.read(target).groupBy("date", "pu_location_id").agg(
        F.sum("trips").alias("trip_count"), F.try_divide(F.sum("fares"), F.sum("priced")).alias("avg_fare")
    )


def daily_metrics_zone_join(
    daily: DataFrame, zones: DataFrame, as_of: Column, days: int = 30, key: str = "pu_location_id"
) -> DataFrame:
    """Stored daily metrics of the last ``days`` days with their zone names."""
    recent = daily.where(F.col("date").between(F.date_sub(as_of, days), as_of))
    named = zones.select(F.col("LocationID").cast("int").alias(key), F.col("Zone").alias("zone_name"))
    return recent.join(named, key).select("date", "zone_name", "trip_count", "avg_fare")
