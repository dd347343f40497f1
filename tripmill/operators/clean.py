"""Row cleaning as named rules, so what is dropped can also be counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.profiles import V1, Profile
from tripmill.operators.quantiles import quantiles, spread

# Limits of the cleaning rules.
MAX_MILES = 100
MAX_PASSENGERS = 10
OUTLIER_PERCENTILE = 0.99
MONEY_AND_DISTANCE = ("trip_distance", "fare_amount", "total_amount")

Rules = Mapping[str, Column]


def presence_rules(profile: Profile = V1) -> Rules:
    critical = (profile.pickup, profile.dropoff, *MONEY_AND_DISTANCE)
    return {f"{name}_missing": F.col(name).isNotNull() for name in critical}


def range_rules() -> Rules:
    miles, riders = F.col("trip_distance"), F.col("passenger_count")
    return {
        "distance_out_of_range": (miles > 0) & (miles < MAX_MILES),
        "fare_not_positive": F.col("fare_amount") > 0,
        "total_not_positive": F.col("total_amount") > 0,
        "passengers_out_of_range": (riders > 0) & (riders < MAX_PASSENGERS),
    }


def standard_rules(profile: Profile = V1) -> Rules:
    return {**presence_rules(profile), **range_rules()}


def keep_if(rules: Rules) -> Column:
    """All rules hold; a rule that cannot be decided (null) does not hold."""
    return reduce(lambda left, right: left & right, rules.values())


def drop_null_critical(df: DataFrame, profile: Profile = V1) -> DataFrame:
    return df.where(keep_if(presence_rules(profile)))


def clean_trips(df: DataFrame, profile: Profile = V1) -> DataFrame:
    """Rows passing every standard rule, with distance and money as doubles."""
    kept = df.where(keep_if(standard_rules(profile)))
    return kept.withColumns({name: F.col(name).cast("double") for name in MONEY_AND_DISTANCE})


def flag_valid(df: DataFrame, rules: Rules, name: str = "is_valid") -> DataFrame:
    return df.withColumn(name, F.coalesce(keep_if(rules), F.lit(False)))


def reject_reasons(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows per failed rule; a row failing several rules counts under each."""
    failed = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    reasons = F.explode(F.array_compact(F.array(*failed)))
    return df.select(reasons.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def outlier_rules(limits: Column, profile: Profile = V1) -> Rules:
    return {
        "distance_negative": F.col("trip_distance") >= 0,
        "fare_negative": F.col("fare_amount") >= 0,
        "total_negative": F.col("total_amount") >= 0,
        "no_passengers": F.col("passenger_count") > 0,
        "distance_outlier": F.col("trip_distance") < limits.getField("trip_distance"),
        "total_outlier": F.col("total_amount") < limits.getField("total_amount"),
        "dropoff_not_after_pickup": F.col(profile.dropoff) > F.col(profile.pickup),
    }


def percentile_limits(df: DataFrame, columns: Sequence[str], p: float, approx: bool = False) -> Column:
    """A scalar struct with the given percentile of each column of ``df``.

    It is a subquery evaluated once, so no join is needed to compare rows with it.
    """
    found = spread(quantiles(df, columns, [p], approx=approx), {p: "limit"})
    picks = [F.max(F.when(F.col("metric") == name, F.col("limit"))).alias(name) for name in columns]
    return found.agg(F.struct(*picks).alias("limits")).scalar()


def clean_trips_p99(df: DataFrame, profile: Profile = V1, approx: bool = False) -> DataFrame:
    """Non-negative trips with riders, in time order, strictly below the 99th
    percentile of distance and total of the raw input."""
    limits = percentile_limits(df, ("trip_distance", "total_amount"), OUTLIER_PERCENTILE, approx)
    return df.where(keep_if(outlier_rules(limits, profile)))


def recent_window(df: DataFrame, as_of: Column, days: int = 30, column: str = "pickup_date") -> DataFrame:
    """Rows dated within ``days`` before ``as_of``, both ends included."""
    return df.where(F.col(column).between(F.date_sub(as_of, days), as_of))
