"""The report catalogue: metric tables, views, demand and revenue reports.

Simple reports are :class:`Report` values; those with a second step are
functions of a trip frame. ``REPORTS_*`` name the trip table each one reads.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import columns as C
from tripmill.functions.profiles import ORDER_DISTANCE, ORDER_V1, ORDER_V2
from tripmill.operators.reports import COUNT, Report, avg, count_of, count_where, std, total
from tripmill.operators.sampling import top_n_by

FARE = avg("total_amount")
MILES = avg("trip_distance")
MINUTES = avg("trip_duration_minutes")
SPEED = avg("speed_mph")
TIP = avg("tip_percentage")
REVENUE = total("total_amount")

# Metric tables and views over the V1 trip table.
REPORTS_V1: dict[str, Report] = {
    "daily_metrics": Report(
        ("pickup_date",),
        {
            "total_trips": COUNT,
            "total_revenue": REVENUE,
            "avg_distance": MILES,
            "avg_duration": MINUTES,
            "avg_tip_percentage": TIP,
        },
    ),
    "hourly_metrics": Report(("pickup_date", "pickup_hour"), {"trips_per_hour": COUNT, "avg_fare_per_hour": FARE}),
    "location_metrics": Report(
        ("pu_location_id",), {"pickups_count": COUNT, "avg_fare": FARE, "avg_trip_distance": MILES}
    ),
    "payment_metrics": Report(
        ("payment_type_desc",), {"payment_count": COUNT, "total_revenue": REVENUE, "avg_tip_percentage": TIP}
    ),
    "viz_hourly_patterns": Report(
        ("pickup_hour",),
        {"total_trips": COUNT, "avg_fare": FARE, "avg_distance": MILES, "avg_duration": MINUTES},
        order=("pickup_hour",),
    ),
    "viz_daily_revenue": Report(
        ("pickup_date",),
        {
            "total_trips": COUNT,
            "total_revenue": REVENUE,
            "avg_tip_percentage": TIP,
            "card_revenue": total("total_amount", ("payment_type_desc", "credit_card")),
            "cash_revenue": total("total_amount", ("payment_type_desc", "cash")),
        },
        order=("pickup_date",),
    ),
    "viz_distance_distribution": Report(
        ("distance_category",),
        {"trip_count": COUNT, "avg_fare": FARE, "avg_duration": MINUTES, "avg_tip_percentage": TIP},
        order=(("distance_category", ORDER_DISTANCE),),
    ),
    "viz_payment_analysis": Report(
        ("payment_type_desc",),
        {"trip_count": COUNT, "avg_fare": FARE, "avg_tip_percentage": TIP, "avg_distance": MILES},
        order=("-trip_count", "payment_type_desc"),
    ),
    "viz_time_performance": Report(
        ("time_of_day",),
        {
            "total_trips": COUNT,
            "avg_fare": FARE,
            "avg_duration": MINUTES,
            "avg_speed": SPEED,
            "avg_tip_percentage": TIP,
        },
        order=(("time_of_day", ORDER_V1),),
    ),
    "viz_weekday_weekend": Report(
        (("day_type", lambda: C.day_type("is_weekend")),),
        {
            "total_trips": COUNT,
            "avg_fare": FARE,
            "avg_distance": MILES,
            "avg_duration": MINUTES,
            "avg_tip_percentage": TIP,
        },
    ),
    "viz_location_performance": Report(
        ("pu_location_id",),
        {
            "total_pickups": COUNT,
            "avg_fare": FARE,
            "avg_distance": MILES,
            "avg_tip_percentage": TIP,
            "morning_rush_trips": count_where("time_of_day", "morning_rush"),
            "evening_rush_trips": count_where("time_of_day", "evening_rush"),
        },
        order=("-total_pickups", "pu_location_id"),
    ),
}

# Reports and views over the V2 (analytics) trip table.
REPORTS_V2: dict[str, Report] = {
    "location_trip_counts": Report(
        ("pickup_location_id",),
        {"trip_count": COUNT, "avg_fare": avg("fare_amount")},
        order=("-trip_count", "pickup_location_id"),
    ),
    "view_trip_volume": Report(
        ("pickup_hour", "pickup_dayofweek", "time_of_day"),
        {"trip_count": COUNT, "avg_fare": FARE, "avg_distance": MILES},
    ),
    "view_financial": Report(
        ("payment_type", "time_of_day", "is_weekend"),
        {
            "trip_count": COUNT,
            "avg_fare": FARE,
            "avg_tip_percentage": TIP,
            "avg_cost_per_mile": avg("cost_per_mile"),
        },
    ),
    "view_geographic": Report(
        ("pickup_location_id", "dropoff_location_id"),
        {"trip_count": COUNT, "avg_distance": MILES, "avg_fare": FARE, "avg_speed": SPEED},
    ),
    "view_performance": Report(
        ("trip_distance_category", "time_of_day", "is_weekend"),
        {"trip_count": COUNT, "avg_speed": SPEED, "avg_duration": MINUTES, "avg_fare": FARE},
    ),
    "hourly_demand": Report(
        ("pickup_hour",),
        {
            "total_trips": COUNT,
            "avg_fare": FARE,
            "avg_distance": MILES,
            "avg_duration": MINUTES,
            "avg_speed": SPEED,
        },
        order=("pickup_hour",),
        digits=2,
    ),
    "revenue_by_location": Report(
        ("pickup_location_id",),
        {
            "total_trips": COUNT,
            "total_revenue": REVENUE,
            "avg_fare": FARE,
            "avg_distance": MILES,
            "avg_tip_percent": TIP,
        },
        order=("-total_revenue", "pickup_location_id"),
        digits=2,
        top=10,
    ),
    "payment_patterns": Report(
        ("payment_type",),
        {
            "total_trips": COUNT,
            "total_revenue": REVENUE,
            "avg_tip_percent": TIP,
            "avg_fare": FARE,
            "weekend_trips": count_where("is_weekend", True),
            "rush_hour_trips": count_where("is_rush_hour", True),
        },
        order=("-total_trips", "payment_type"),
        digits=2,
    ),
    "trip_distance_analysis": Report(
        ("trip_distance_category",),
        {
            "total_trips": COUNT,
            "avg_fare": FARE,
            "avg_duration": MINUTES,
            "avg_speed": SPEED,
            "avg_tip_percent": TIP,
        },
        order=(("trip_distance_category", ORDER_DISTANCE),),
        digits=2,
    ),
    "weekday_weekend_comparison": Report(
        (("day_type", lambda: C.day_type("is_weekend")),),
        {
            "total_trips": COUNT,
            "avg_fare": FARE,
            "avg_distance": MILES,
            "avg_duration": MINUTES,
            "avg_tip_percent": TIP,
            "avg_speed": SPEED,
        },
        digits=2,
    ),
    "rush_hour_impact": Report(
        ("time_of_day",),
        {
            "total_trips": COUNT,
            "avg_fare": FARE,
            "avg_speed": SPEED,
            "avg_duration": MINUTES,
            "avg_tip_percent": TIP,
        },
        order=(("time_of_day", ORDER_V2),),
        digits=2,
    ),
    "hour_day_counts": Report(
        ("pickup_hour", ("day_of_week", lambda: F.dayofweek("pickup_date"))),
        {"trip_count": COUNT},
        order=("day_of_week", "pickup_hour"),
    ),
    "hourly_fare_spread": Report(
        ("pickup_hour",),
        {"avg_fare": avg("fare_amount"), "std_fare": std("fare_amount"), "trip_count": COUNT},
        order=("pickup_hour",),
    ),
    "radar_profile": Report(
        ("time_of_day",), {"avg_speed": SPEED, "avg_fare": FARE, "avg_tip": TIP, "avg_distance": MILES}
    ),
    "location_profile": Report(
        ("pickup_location_id",),
        {
            "total_trips": COUNT,
            "avg_fare": FARE,
            "avg_distance": MILES,
            "avg_tip_percent": TIP,
            "avg_speed": SPEED,
        },
    ),
    "chart_hourly_trips": Report(
        (("hour", lambda: F.hour("pickup_datetime")),), {"trip_count": COUNT}, order=("hour",)
    ),
    "chart_revenue_by_payment": Report(("payment_type",), {"total_revenue": REVENUE}),
    "chart_daily_revenue": Report(
        (("date", lambda: F.to_date("pickup_datetime")),), {"daily_revenue": REVENUE}, order=("date",)
    ),
    "trips_by_hour": Report(("pickup_hour",), {"trip_count": count_of("trip_id")}),
    "trips_by_dayofweek": Report(("pickup_dayofweek",), {"trip_count": count_of("trip_id")}),
    "trips_by_weekend": Report(("is_weekend",), {"trip_count": count_of("trip_id")}),
    "mean_by_time": Report(
        ("time_of_day",),
        {"avg_fare": FARE, "avg_tip_percentage": TIP, "avg_speed": SPEED},
    ),
}

# Statistics over the zone-enriched V4 trip table.
REPORTS_V4: dict[str, Report] = {
    "overall_stats": Report(
        (),
        {
            "total_trips": COUNT,
            "avg_trip_duration": MINUTES,
            "avg_distance": MILES,
            "avg_fare": FARE,
            "avg_tip": avg("tip_amount"),
            "total_revenue": REVENUE,
        },
        digits=2,
    ),
    "borough_stats": Report(
        ("pickup_borough",),
        {"trips": COUNT, "avg_distance": MILES, "avg_fare": FARE, "total_revenue": REVENUE},
        digits=2,
    ),
    "time_stats": Report(("time_of_day",), {"trips": COUNT, "avg_duration": MINUTES, "avg_fare": FARE}, digits=2),
    "popular_routes": Report(
        ("pickup_zone", "dropoff_zone"),
        {"trip_count": COUNT, "avg_fare": FARE},
        order=("-trip_count", "pickup_zone", "dropoff_zone"),
        digits=2,
        top=10,
    ),
}


def all_rows():
    """A window over a whole aggregated frame of a few dozen rows."""
    return Window.partitionBy(F.lit(0))


def with_spread(counts: DataFrame, column: str, mean: str, spread: str) -> DataFrame:
    """Mean and standard deviation of a column beside every row of a small frame."""
    return counts.withColumns(
        {mean: F.avg(column).over(all_rows()), spread: F.stddev_samp(column).over(all_rows())}
    )


def peak_hours(df: DataFrame) -> DataFrame:
    """Hourly demand with a level against mean and deviation of the hourly counts.

    The trips are read once: the statistics are taken over the 24 hourly rows.
    """
    return with_demand_level(HOURLY_COUNTS(df))


HOURLY_COUNTS = Report(("pickup_hour",), {"trip_count": COUNT, "avg_fare": FARE, "avg_tip_percent": TIP})


def with_demand_level(hourly: DataFrame) -> DataFrame:
    """Hourly counts with a level against the mean and deviation of all of them."""
    measured = with_spread(hourly, "trip_count", "_mean", "_spread")
    level = C.demand_level("trip_count", F.col("_mean"), F.col("_spread"))
    return measured.withColumn("demand_level", level).drop("_mean", "_spread").orderBy("pickup_hour")


def summary_report(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row of totals, averages and distinct location counts.

    Exact distinct counts are taken over one row per location pair, so trips
    are neither expanded nor shuffled for them.
    """
    averages = {
        "avg_fare": "total_amount",
        "avg_distance": "trip_distance",
        "avg_duration": "trip_duration_minutes",
        "avg_tip_percent": "tip_percentage",
        "avg_speed": "speed_mph",
    }
    places = ("pickup_location_id", "dropoff_location_id")
    uniques = {"unique_pickup_locations": places[0], "unique_dropoff_locations": places[1]}
    if approx:
        return df.agg(
            F.count(F.lit(1)).alias("total_trips"),
            C.stable_round(F.sum("total_amount"), 2).alias("total_revenue"),
            *[C.stable_round(F.avg(source), 2).alias(name) for name, source in averages.items()],
            *[F.approx_count_distinct(source).alias(name) for name, source in uniques.items()],
        )
    pairs = df.groupBy(*places).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_sum_{c}") for c in averages.values()],
        *[F.count(c).alias(f"_count_{c}") for c in averages.values()],
    )

    def mean(column: str):
        return C.stable_round(F.try_divide(F.sum(f"_sum_{column}"), F.sum(f"_count_{column}")), 2)

    return pairs.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_trips"),
        C.stable_round(F.sum("_sum_total_amount"), 2).alias("total_revenue"),
        *[mean(source).alias(name) for name, source in averages.items()],
        *[F.count_distinct(source).alias(name) for name, source in uniques.items()],
    )


def demand_heatmap(df: DataFrame) -> DataFrame:
    """Trips by weekday (rows) and hour (columns ``h0`` to ``h23``)."""
    return heatmap_of(REPORTS_V2["hour_day_counts"](df))


def heatmap_of(counts: DataFrame) -> DataFrame:
    """Counts per weekday and hour with the hours as columns."""
    hours = [F.max(F.when(F.col("pickup_hour") == h, F.col("trip_count"))).alias(f"h{h}") for h in range(24)]
    return counts.groupBy("day_of_week").agg(*hours)


def distance_time_pivot(df: DataFrame, labels: Sequence[str] = ORDER_V2) -> DataFrame:
    """Trips by distance category (rows) and time of day (columns), 0 where none."""
    pivoted = df.groupBy("trip_distance_category").pivot("time_of_day", list(labels)).count()
    return pivoted.fillna(0, list(labels))


def top_pickup_locations(df: DataFrame, n: int = 10) -> DataFrame:
    """Busiest pickup locations from the location-pair view.

    ``avg_fare`` is the plain mean of the pair averages, ``weighted_fare``
    weights them by trips.
    """
    pairs = REPORTS_V2["view_geographic"](df)
    priced = F.when(F.col("avg_fare").isNotNull(), F.col("trip_count"))
    busiest = pairs.groupBy("pickup_location_id").agg(
        F.sum("trip_count").alias("trip_count"),
        F.avg("avg_fare").alias("avg_fare"),
        F.try_divide(F.sum(F.col("avg_fare") * F.col("trip_count")), F.sum(priced)).alias("weighted_fare"),
    )
    return top_n_by(busiest, "trip_count", n, ["pickup_location_id"])


def time_grain_rollup(df: DataFrame, grain: str = "day", limit: int | None = None, column: str = "pickup_datetime") -> DataFrame:
    """Trips per time grain; a chart's ``limit`` keeps the earliest grains only."""
    when = F.date_trunc(grain, F.col(column).cast("timestamp_ntz")).cast("timestamp_ntz")
    counts = df.groupBy(when.alias("period")).agg(F.count(F.lit(1)).alias("trip_count"))
    return counts if limit is None else counts.orderBy("period").limit(limit)


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), column)
    )
    return counts if n is None else counts.limit(n)


def payment_share(df: DataFrame) -> DataFrame:
    """Trips per payment type and their share of all trips."""
    counts = df.groupBy("payment_type").agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.withColumn("share", F.col("trip_count") / F.sum("trip_count").over(all_rows()))


def scatter_speed_distance(df: DataFrame) -> DataFrame:
    """Location pairs with average distance, speed and fare."""
    return REPORTS_V2["view_geographic"](df).select(
        "pickup_location_id", "dropoff_location_id", "avg_distance", "avg_speed", "avg_fare"
    )


COMPOSED_V2: dict[str, Callable[[DataFrame], DataFrame]] = {
    "peak_hours": peak_hours,
    "summary_report": summary_report,
    "demand_heatmap": demand_heatmap,
    "distance_time_pivot": distance_time_pivot,
    "top_pickup_locations": top_pickup_locations,
    "time_grain_rollup": time_grain_rollup,
    "payment_share": payment_share,
    "scatter_speed_distance": scatter_speed_distance,
}

METRIC_TABLES = ("daily_metrics", "hourly_metrics", "location_metrics", "payment_metrics")
VISUAL_VIEWS = tuple(name for name in REPORTS_V1 if name.startswith("viz_"))
DASHBOARD_VIEWS = tuple(name for name in REPORTS_V2 if name.startswith("view_"))
