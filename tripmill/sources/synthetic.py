"""Deterministic synthetic trips, one per input id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import features, profiles
from tripmill.schemas import SAMPLE_TRIP

# Ranges and labels of the generated trips.
BASE_TIME = "2023-01-01 00:00:00"
HOURS = 24 * 30
FIRST_MINUTES, MINUTES = 5, 115
LOCATION_IDS = 263
PASSENGERS = 6
DISTANCE_RANGE = (0.5, 30.0)
FARE_RANGE = (2.5, 100.0)
TIP_RANGE = (0.0, 20.0)
PAYMENTS = ("CREDIT", "CASH", "MOBILE")
TRIP_TYPES = ("STREET_HAIL", "DISPATCH")
STEPS = 1_000_000


def _draws(key: Column, seed: int) -> tuple[dict[str, Column], Callable[[int], Column]]:
    """Digest columns per row and a picker of 32-bit integers out of them."""
    digests = {
        f"_digest_{part}": F.md5(F.concat_ws("/", F.lit(seed), F.lit(part), key.cast("string")))
        for part in range(3)
    }

    def pick(number: int) -> Column:
        part, slot = divmod(number, 4)
        text = F.substring(f"_digest_{part}", slot * 8 + 1, 8)
        return F.conv(text, 16, 10).cast("long")

    return digests, pick


def _between(draw: Column, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return F.lit(low) + (draw % STEPS) / F.lit(STEPS) * F.lit(high - low)


def _one_of(draw: Column, labels: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), (draw % len(labels) + 1).cast("int"))


def generate_trips(ids: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """A trip for every row of ``ids``; equal keys and seed give equal trips.

    Rows are drawn from a digest of the key, so any partitioning and any rerun
    of a lost task produces the same rows.
    """
    digests, pick = _draws(F.col(key), seed)
    pickup = F.timestamp_add("HOUR", (pick(0) % HOURS).cast("int"), F.lit(BASE_TIME).cast("timestamp_ntz"))
    minutes = (pick(1) % MINUTES + FIRST_MINUTES).cast("int")
    base = ids.select(F.col(key)).withColumns(digests)
    drawn = base.select(
        pickup.alias("pickup_datetime"),
        minutes.alias("_minutes"),
        (pick(2) % LOCATION_IDS + 1).cast("int").alias("pickup_location_id"),
        (pick(3) % LOCATION_IDS + 1).cast("int").alias("dropoff_location_id"),
        (pick(4) % PASSENGERS + 1).cast("int").alias("passenger_count"),
        _between(pick(5), DISTANCE_RANGE).alias("trip_distance"),
        _between(pick(6), FARE_RANGE).alias("fare_amount"),
        _between(pick(7), TIP_RANGE).alias("tip_amount"),
        _one_of(pick(8), PAYMENTS).alias("payment_type"),
        _one_of(pick(9), TRIP_TYPES).alias("trip_type"),
    ).withColumns(
        {
            "dropoff_datetime": F.timestamp_add("MINUTE", F.col("_minutes"), F.col("pickup_datetime")),
            "total_amount": F.col("fare_amount") + F.col("tip_amount"),
        }
    )
    derived = features.add_features(drawn, profiles.V5).withColumn(
        "pickup_dayofweek", F.date_format("pickup_datetime", "EEEE")
    )
    return derived.select(*[F.col(name) for name in SAMPLE_TRIP.fieldNames()])


def sample_trips(spark: SparkSession, rows: int = 1000, seed: int = 42) -> DataFrame:
    return generate_trips(spark.range(rows), "id", seed)
