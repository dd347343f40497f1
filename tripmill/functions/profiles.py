"""Feature profiles: which label bands, names and zero rules a trip table follows.

The same feature has several definitions in use. Each one is data here, so a
report can ask for the labels it was written against.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values: (last hour of the band, label).
FIVE_V1 = (
    (5, "late_night"),
    (10, "morning_rush"),
    (16, "midday"),
    (20, "evening_rush"),
    (23, "night"),
)
FIVE_V2 = (
    (6, "early_morning"),
    (10, "morning_rush"),
    (15, "midday"),
    (19, "evening_rush"),
    (23, "night"),
)
FOUR_V4 = (
    (5, "Night"),
    (10, "Morning Rush"),
    (16, "Midday"),
    (20, "Evening Rush"),
    (23, "Night"),
)
FOUR_V5 = (
    (6, "NIGHT"),
    (12, "MORNING"),
    (18, "AFTERNOON"),
    (24, "EVENING"),
)
# Fixed values: (largest distance of the band in miles, label).
DISTANCE = (
    (2.0, "short"),
    (5.0, "medium"),
    (10.0, "long"),
    (float("inf"), "very_long"),
)
DISTANCE_UPPER = tuple((edge, label.upper()) for edge, label in DISTANCE)

# Display order of the labels.
ORDER_V1 = ("morning_rush", "midday", "evening_rush", "night", "late_night")
ORDER_V2 = ("early_morning", "morning_rush", "midday", "evening_rush", "night")
ORDER_DISTANCE = ("short", "medium", "long", "very_long")

# Payment code and description.
PAYMENT_LABELS = {1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute"}
PAYMENT_UNKNOWN = "unknown"

RUSH_LABELS = ("morning_rush", "evening_rush")
LONG_TRIP_MILES = 10

TIME_BANDS = {
    "five_v1": FIVE_V1,
    "five_v2": FIVE_V2,
    "four_v4": FOUR_V4,
    "four_v5": FOUR_V5,
}


@dataclass(frozen=True)
class Profile:
    """Choices that differ between the trip tables.

    ``on_zero`` rules the ratios: ``"zero"`` gives 0 unless the divisor is
    positive, ``"null"`` gives null for a zero divisor. Ratios named in
    ``positive_only`` give null unless the divisor is positive.
    """

    name: str
    pickup: str = "pickup_datetime"
    dropoff: str = "dropoff_datetime"
    time_bands: str = "five_v2"
    distance_bands: tuple = DISTANCE
    distance_floor: float | None = None
    distance_label: str = "trip_distance_category"
    on_zero: str = "null"
    positive_only: tuple[str, ...] = ()
    rounded: bool = True
    numeric_flags: bool = False


V1 = Profile(
    "v1",
    pickup="tpep_pickup_datetime",
    dropoff="tpep_dropoff_datetime",
    time_bands="five_v1",
    distance_label="distance_category",
    on_zero="zero",
    numeric_flags=True,
)
V2 = Profile("v2", positive_only=("cost_per_mile",))
LOCAL = replace(V2, name="local", rounded=False, distance_floor=0.0, positive_only=())
V4 = Profile(
    "v4",
    pickup="tpep_pickup_datetime",
    dropoff="tpep_dropoff_datetime",
    time_bands="four_v4",
    positive_only=("cost_per_minute",),
)
V5 = replace(
    V2,
    name="v5",
    time_bands="four_v5",
    distance_bands=DISTANCE_UPPER,
    distance_floor=0.0,
    rounded=False,
    positive_only=(),
)
