"""Every operator as a named query over the given tables.

Averages and sums of doubles are rounded here, as the last bits depend on the
order of addition; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import schemas
from tripmill.functions import columns as C
from tripmill.functions import features, profiles
from tripmill.operators import bundles, clean, cluster, outliers, quality, sampling, stats, timeseries, zones
from tripmill.plans import catalog, processing
from tripmill.session import settle, shared_dir
from tripmill.sources import calendar, files, publish, star, synthetic, tables, writers
from tripmill.streaming import landing, windows

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
MONTH = (1996, 5)
AS_OF_DAYS = 30


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, other columns as they are."""
    return df.select(
        *[
            C.stable_round(f"`{f.name}`", digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


class Tables:
    """Trip tables derived from one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return star.read_table(self.spark, self.folder, name)

    def trips(self) -> DataFrame:
        return star.trips(self.spark, self.folder).drop("order_key")

    def raw(self) -> DataFrame:
        """Trips with missing values and swapped times."""
        return star.blemish(star.trips(self.spark, self.folder)).drop("order_key")

    def raw_by_month(self) -> DataFrame:
        """The same trips, rebalanced by pickup month."""
        return star.trips_by_month(self.spark, self.folder).drop("order_key")

    def zones(self) -> DataFrame:
        return star.zones(self.spark, self.folder)

    def v1(self) -> DataFrame:
        return processing.derive_v1(self.raw())

    def v2(self) -> DataFrame:
        return processing.derive_v2(self.raw())

    def v4(self) -> DataFrame:
        return processing.derive_v4(self.raw(), self.zones())

    def shared(self, purpose: str) -> str:
        return shared_dir(self.spark, purpose)


Build = Callable[[Tables], DataFrame]
_BUILDERS: dict[str, Build] = {}


def register(name: str) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        _BUILDERS[name] = build
        return build

    return add


def add(name: str, build: Build) -> None:
    _BUILDERS[name] = build


def frequency(df: DataFrame, *names: str) -> DataFrame:
    """Rows per distinct value of the named columns."""
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count"))


# ---------------------------------------------------------------- sources

add("scan_parquet_inferred", lambda t: files.scan_parquet(t.spark, f"{t.folder}/orders.parquet"))


@register("scan_month_glob")
def _(t: Tables) -> DataFrame:
    path = t.shared("months")
    writers.write_partitioned(t.v2().select("trip_id", "total_amount", "pickup_year", "pickup_month"), path)
    return files.scan_month(t.spark, path, *MONTH).select("trip_id", "total_amount")


@register("scan_parquet_schema")
def _(t: Tables) -> DataFrame:
    path = t.shared("raw")
    raw = t.raw()
    published = raw.withColumnsRenamed({"pu_location_id": "PULocationID", "do_location_id": "DOLocationID"})
    published.withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(path)
    scanned = files.scan_raw_trips(t.spark, path)
    names = [n for n in schemas.RAW_TRIP.fieldNames() if n in raw.columns]
    return scanned.select(*names).withColumns(
        {n: F.col(n).cast("timestamp_ntz") for n in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )


@register("scan_drifting_months")
def _(t: Tables) -> DataFrame:
    """Month folders in two layouts: other spellings, numbers as fractions or text, times as text, a column more."""
    root, raw = t.shared("drifting"), t.raw().drop("tip_amount")
    raw = raw.withColumns({"file_year": F.year("tpep_pickup_datetime"), "file_month": F.month("tpep_pickup_datetime")})
    early = F.col("file_year") < 1995
    spelled = raw.where(early).withColumnsRenamed({"pu_location_id": "PULocationID", "do_location_id": "DOLocationID", "tpep_pickup_datetime": "Pickup_Datetime"})
    spelled = spelled.withColumns(
        {
            "Pickup_Datetime": F.date_format("Pickup_Datetime", "yyyy-MM-dd HH:mm:ss"),
            "passenger_count": F.when(F.col("passenger_count") == 7, 7.5).otherwise(F.col("passenger_count").cast("double")),
            "payment_type": F.when(F.col("payment_type") == 5, "n/a").otherwise(F.col("payment_type").cast("string")),
            "airport_fee": F.lit(1.25),
        }
    )
    later = raw.where(~early).withColumn("PULocationID", F.col("pu_location_id").cast("long")).drop("pu_location_id")
    for part in (spelled, later):
        writers.write_partitioned(part, root, processing.FILE_MONTH)
    found = files.scan_deliveries(t.spark, root, keep=("trip_id",), reject_column="misfits")
    return found.select(
        "trip_id", "file_year", "file_month", "misfits", "trip_distance", "pu_location_id", "do_location_id", "fare_amount", "total_amount",
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("passenger_count").cast("double").alias("passenger_count"), F.col("payment_type").cast("double").alias("payment_type"),
    )


@register("scan_zone_csv")
def _(t: Tables) -> DataFrame:
    path = t.shared("zones")
    t.zones().write.csv(path, header=True)
    return files.scan_zones(t.spark, path)


@register("scan_table")
def _(t: Tables) -> DataFrame:
    t.v2().createOrReplaceTempView("registered_trips")
    return frequency(tables.scan_table(t.spark, "registered_trips"), "payment_type")


def _month_totals(df: DataFrame) -> DataFrame:
    return rounded(
        df.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trip_count"), F.sum("total_amount").alias("revenue"))
    )


add("scan_month_table", lambda t: _month_totals(tables.month_slice(t.v2(), *MONTH)))
add("fetch_month", lambda t: tables.month_slice(t.v2(), *MONTH).select(*schemas.ANALYTICS_TRIP.fieldNames()))


@register("scan_wildcard")
def _(t: Tables) -> DataFrame:
    sample = synthetic.generate_trips(t.given("orders"), "o_orderkey")
    everything = tables.union_tables([t.v2(), sample.withColumn("pickup_dayofweek", F.dayofweek("pickup_datetime"))])
    return rounded(
        everything.groupBy("payment_type", "trip_type").agg(
            F.count(F.lit(1)).alias("trip_count"), F.avg("total_amount").alias("avg_fare")
        )
    )


@register("run_query")
def _(t: Tables) -> DataFrame:
    text = (
        "SELECT pickup_location_id, count(*) AS trip_count FROM {trips} "
        "WHERE pickup_hour >= :hour GROUP BY pickup_location_id"
    )
    return tables.run_query(t.spark, text, {"hour": 0}, trips=t.v2())


add("generate_trips", lambda t: rounded(synthetic.generate_trips(t.given("orders"), "o_orderkey")))


@register("month_range")
def _(t: Tables) -> DataFrame:
    bounds = t.given("orders").agg(F.min("o_orderdate").alias("first_month"), F.max("o_orderdate").alias("last_month"))
    return calendar.month_range(bounds)


# ---------------------------------------------------------------- sinks


def _stored(t: Tables, purpose: str, write: Callable[[str], object]) -> DataFrame:
    path = t.shared(purpose)
    write(path)
    return t.spark.read.parquet(path)


@register("write_parquet_month")
def _(t: Tables) -> DataFrame:
    stored = _stored(t, "processed", lambda path: writers.write_partitioned(t.v1(), path))
    return rounded(
        stored.groupBy("pickup_year", "pickup_month").agg(
            F.count(F.lit(1)).alias("trip_count"), F.sum("total_amount").alias("revenue")
        )
    )


@register("write_statistics")
def _(t: Tables) -> DataFrame:
    root = t.shared("statistics")
    writers.write_frames(processing.trip_statistics(t.v4()), root)
    return t.spark.read.parquet(f"{root}/by_borough")


@register("write_metric_table")
def _(t: Tables) -> DataFrame:
    monthly = t.v1().groupBy("pickup_year", "pickup_month", "payment_type_desc").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
    )
    path = writers.write_metric_months(monthly, t.shared("metrics"), "payment_metrics")
    return rounded(t.spark.read.parquet(path))


@register("write_trips_partitioned")
def _(t: Tables) -> DataFrame:
    stored = _stored(t, "days", lambda path: writers.write_trips_by_day(t.v1(), path))
    return frequency(stored, "pickup_date", "pickup_hour")


@register("truncate_load")
def _(t: Tables) -> DataFrame:
    sample = synthetic.generate_trips(t.given("orders"), "o_orderkey")
    return frequency(
        _stored(t, "sample", lambda path: writers.truncate_load(sample, path, schemas.SAMPLE_TRIP)), "pickup_dayofweek"
    )


@register("create_view")
def _(t: Tables) -> DataFrame:
    processing.dashboard_views(t.spark, t.v2(), "_registered")
    return rounded(t.spark.table("view_financial_registered"))


@register("append_analytics")
def _(t: Tables) -> DataFrame:
    writers.create_analytics_table(t.spark, "registered_analytics", t.shared("analytics"))
    writers.append_analytics(t.v2(), "registered_analytics")
    stored = tables.scan_table(t.spark, "registered_analytics")
    return rounded(catalog.REPORTS_V2["view_financial"](stored))


@register("write_hash_distributed")
def _(t: Tables) -> DataFrame:
    kept = t.v2().select("pickup_location_id", "pickup_hour", "total_amount")
    writers.write_hash_distributed(kept, "registered_buckets", 8, path=t.shared("buckets"))
    return frequency(tables.scan_table(t.spark, "registered_buckets"), "pickup_location_id")


@register("save_query_result")
def _(t: Tables) -> DataFrame:
    result = catalog.REPORTS_V2["location_trip_counts"](t.v2())
    writers.save_table(result, "registered_result", path=t.shared("result"))
    return rounded(tables.scan_table(t.spark, "registered_result"))


@register("run_sql_script")
def _(t: Tables) -> DataFrame:
    t.v2().createOrReplaceTempView("registered_script_trips")
    writers.run_sql_script(
        t.spark,
        """
        CREATE OR REPLACE TEMP VIEW registered_hours AS
          SELECT pickup_hour, count(*) AS row_count FROM registered_script_trips GROUP BY pickup_hour;
        CREATE OR REPLACE TEMP VIEW registered_busy AS SELECT * FROM registered_hours WHERE pickup_hour >= 0;
        """,
    )
    return t.spark.table("registered_busy")


# ---------------------------------------------------------------- cleaning

add("drop_null_critical", lambda t: clean.drop_null_critical(t.raw()).select("trip_id"))
add(
    "clean_trips",
    lambda t: clean.clean_trips(t.raw()).select(
        "trip_id", "trip_distance", "fare_amount", "total_amount", "passenger_count"
    ),
)
add("clean_trips_p99", lambda t: clean.clean_trips_p99(t.raw()).select("trip_id"))
add(
    "between_hour",
    lambda t: frequency(t.v2().where(F.col("pickup_hour").between(6, 10)), "pickup_hour", "pickup_location_id"),
)
add("in_list", lambda t: frequency(t.v1().where(F.col("payment_type").isin(1, 2)), "payment_type_desc"))


@register("split_weekday_weekend")
def _(t: Tables) -> DataFrame:
    weekend = F.col("is_weekend")

    def side(name: str, condition: Column) -> list[Column]:
        return [
            F.count_if(condition).alias(f"{name}_trips"),
            F.sum(F.when(condition, F.col("total_amount"))).alias(f"{name}_revenue"),
        ]

    return rounded(t.v2().groupBy("time_of_day").agg(*side("weekday", ~weekend), *side("weekend", weekend)))


add("iqr_outliers", lambda t: outliers.iqr_outliers(t.v2()))
add("iqr_outlier_counts", lambda t: outliers.iqr_outlier_counts(t.v2()))


@register("recent_window_filter")
def _(t: Tables) -> DataFrame:
    v2 = t.v2()
    last = v2.agg(F.max("pickup_date").alias("last")).scalar()
    return frequency(clean.recent_window(v2, last, AS_OF_DAYS), "pickup_date")


# ---------------------------------------------------------------- features

_V1_FEATURES = {
    "time_of_day_v1": "time_of_day",
    "is_long_trip": "is_long_trip",
    "payment_type_desc": "payment_type_desc",
    "speed_mph_v1": "speed_mph",
    "cost_per_mile_v1": "cost_per_mile",
    "cost_per_minute_v1": "cost_per_minute",
    "tip_percentage_v1": "tip_percentage",
}
_V2_FEATURES = {
    "pickup_date": "pickup_date",
    "pickup_hour": "pickup_hour",
    "pickup_day": "pickup_day",
    "pickup_month_year": ("pickup_year", "pickup_month"),
    "pickup_dayofweek": "pickup_dayofweek",
    "trip_duration_minutes": "trip_duration_minutes",
    "is_weekend": "is_weekend",
    "is_rush_hour": "is_rush_hour",
    "time_of_day": "time_of_day",
    "speed_mph": "speed_mph",
    "distance_category": "trip_distance_category",
    "cost_per_mile": "cost_per_mile",
    "cost_per_minute": "cost_per_minute",
    "tip_percentage": "tip_percentage",
}


def _feature(names: str | tuple[str, ...], table: str, t: Tables) -> DataFrame:
    return frequency(getattr(t, table)(), *((names,) if isinstance(names, str) else names))


for _table, _features in (("v1", _V1_FEATURES), ("v2", _V2_FEATURES)):
    for _name, _columns in _features.items():
        add(_name, partial(_feature, _columns, _table))


@register("parse_timestamps")
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("payment_type") == 5, F.lit("n/a")).otherwise(
        F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    )
    asked = t.raw().select(
        "trip_id",
        text.alias("pickup_datetime"),
        F.date_format("tpep_dropoff_datetime", "yyyy-MM-dd HH:mm:ss").alias("dropoff_datetime"),
    )
    parsed = features.parse_timestamps(asked)
    return parsed.withColumns(
        {n: F.col(n).cast("timestamp_ntz") for n in ("pickup_datetime", "dropoff_datetime")}
    )


add("pickup_dayname", lambda t: frequency(t.v2().select(F.date_format("pickup_datetime", "EEEE").alias("day_name")), "day_name"))


@register("time_of_day_profiles")
def _(t: Tables) -> DataFrame:
    bands = {name: C.bin_cut("pickup_hour", edges) for name, edges in profiles.TIME_BANDS.items()}
    return frequency(t.v2().select("pickup_hour").withColumns(bands), "pickup_hour", *bands)


@register("bin_cut")
def _(t: Tables) -> DataFrame:
    label = C.bin_cut("trip_distance", profiles.DISTANCE_UPPER, 0.0)
    return frequency(t.raw().select("trip_distance", label.alias("label")), "trip_distance", "label")


add("features_v1", lambda t: t.v1())
add("features_v2", lambda t: t.v2())
add(
    "features_local",
    lambda t: rounded(features.add_features(tables.to_analytics_names(t.raw()), profiles.LOCAL)),
)
add("day_type", lambda t: frequency(t.v2().select(C.day_type("is_weekend").alias("day_type")), "day_type"))


@register("demand_level")
def _(t: Tables) -> DataFrame:
    counts = catalog.REPORTS_V2["location_trip_counts"](t.v2())
    shape = counts.agg(
        F.struct(F.avg("trip_count").alias("mean"), F.stddev_samp("trip_count").alias("spread")).alias("shape")
    ).scalar()
    level = C.demand_level("trip_count", shape.getField("mean"), shape.getField("spread"))
    return counts.select("pickup_location_id", "trip_count", level.alias("demand_level"))


add(
    "month_start",
    lambda t: frequency(t.v2().select(C.month_start("pickup_year", "pickup_month").alias("month_start")), "month_start"),
)
add(
    "date_hour_extract",
    lambda t: frequency(
        t.v2().select(F.to_date("pickup_datetime").alias("date"), F.hour("pickup_datetime").alias("hour")), "date", "hour"
    ),
)


@register("landing_path")
def _(t: Tables) -> DataFrame:
    path = C.landing_path("pickup_year", "pickup_month")
    months = frequency(t.v2(), "pickup_year", "pickup_month")
    name = F.element_at(F.split(path, "/"), -1)
    return months.select(
        path.alias("path"),
        C.dated_file_name(name, C.month_start("pickup_year", "pickup_month")).alias("dated_name"),
        "row_count",
    )


# ---------------------------------------------------------------- zones

add(
    "zone_enrich",
    lambda t: zones.zone_enrich(t.raw(), t.zones()).select(
        "trip_id", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"
    ),
)
add(
    "zone_enrich_features",
    lambda t: zones.zone_enrich_features(t.raw(), t.zones()).select(
        "trip_id", "pickup_zone", "dropoff_zone", "trip_duration_minutes", "cost_per_minute",
        "pickup_hour", "pickup_day", "pickup_month", "is_weekend", "time_of_day",
    ),
)


@register("cross_stats")
def _(t: Tables) -> DataFrame:
    return rounded(catalog.with_spread(frequency(t.v2(), "pickup_hour"), "row_count", "avg_trips", "stddev_trips"))


add("value_semi_join", lambda t: rounded(outliers.outlier_rows(_settled(t.v2().select("trip_id", "speed_mph")), "speed_mph", stored=True)))
add("broadcast_zone_rollup", lambda t: rounded(zones.zone_rollup(t.raw(), t.zones())))


@register("daily_metrics_zone_join")
def _(t: Tables) -> DataFrame:
    daily = zones.daily_location_rollup(t.v1())
    last = t.v1().agg(F.max("pickup_date").alias("last")).scalar()
    return rounded(zones.daily_metrics_zone_join(daily, t.zones(), last, AS_OF_DAYS))


add("zone_gap_report", lambda t: zones.zone_gap_report(t.raw(), t.zones().where(F.col("LocationID") % 10 != 7)))

# ---------------------------------------------------------------- reports


def _report(table: str, report: Callable[[DataFrame], DataFrame], t: Tables) -> DataFrame:
    return rounded(report(getattr(t, table)()))


for _table, _reports in (
    ("v1", catalog.REPORTS_V1),
    ("v2", catalog.REPORTS_V2),
    ("v4", catalog.REPORTS_V4),
    ("v2", catalog.COMPOSED_V2),
):
    for _name, _run in _reports.items():
        add(_name, partial(_report, _table, _run))

add("value_counts", lambda t: catalog.value_counts(t.v2(), "trip_distance_category"))
add("value_counts_top_pickups", lambda t: catalog.value_counts(t.v2(), "pickup_location_id", 10))
add("daily_location_rollup", lambda t: rounded(zones.daily_location_rollup(t.v1())))


@register("incremental_rollup")
def _(t: Tables) -> DataFrame:
    """The stored daily rollup after one month is delivered again with fewer trips: only that month is read anew."""
    tables = publish.Publication(t.spark, t.shared("rollup"))
    months = {"file_year": F.col("pickup_year"), "file_month": F.col("pickup_month")}
    trips = t.v1().select("pickup_date", "pu_location_id", "fare_amount", "passenger_count", "pickup_year", "pickup_month").withColumns(months)
    year, month = MONTH
    again = trips.where((F.col("file_year") == year) & (F.col("file_month") == month) & (F.col("passenger_count") >= 3))
    for run, frame in (("first", trips), ("again", again)):
        staged = tables.stage(frame, "trips", run, processing.FILE_MONTH)
        tables.publish([staged], [f"file_year={year}/file_month={month}"])
        zones.refresh_daily_rollup(tables, "trips", processing.FILE_MONTH)
    return rounded(zones.stored_daily_rollup(tables))



#: Key columns that are numbers, by part of a bundle.
BUNDLE_KEYS: dict[str, tuple[str, ...]] = {
    "hourly_metrics": ("pickup_date", "pickup_hour"),
    "location_metrics": ("pu_location_id",),
    "hourly_patterns": ("pickup_hour",),
    "daily_patterns": ("pickup_dayofweek",),
    "top_pickups": ("pickup_location_id",),
    "peak_hours": ("pickup_hour", "demand_level"),
    "hourly_demand": ("pickup_hour",),
    "revenue_by_location": ("pickup_location_id",),
    "heatmap": ("day_of_week",),
    "viz_hourly_patterns": ("pickup_hour",),
    "viz_location_performance": ("pu_location_id",),
}


def _long(frames: dict[str, DataFrame], before: tuple[str, ...] = ()) -> DataFrame:
    """Every measure of a bundle; key columns named ``before`` stand in front."""
    keys = {name: (*before, *BUNDLE_KEYS.get(name, _text_columns(frame))) for name, frame in frames.items()}
    return bundles.long_form(frames, keys)


def _text_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema if not isinstance(f.dataType, T.NumericType)]


def _eda(frames: dict[str, DataFrame]) -> DataFrame:
    return _long(frames | {"basic_stats": rounded(frames["basic_stats"], 5)})


@register("analysis_bundle")
def _(t: Tables) -> DataFrame:
    frames = processing.analysis_bundle(_settled(t.v2()))
    return _long(frames | {"trend": rounded(frames["trend"], 5)})


def _settled(trips: DataFrame) -> DataFrame:
    """The trips stored once, as every part of a bundle reads them."""
    return settle(trips, "trips")


add("trip_statistics", lambda t: _long(processing.trip_statistics(t.v4())))
add("trip_metrics", lambda t: _long(processing.trip_metrics(t.v1())))
add("eda_summary", lambda t: _eda(processing.eda_summary(_settled(t.v2()))))
add("eda_run", lambda t: _eda(processing.eda_run(_settled(t.v2()))))

# ---------------------------------------------------------------- time series


def _monthly(t: Tables) -> DataFrame:
    return timeseries.monthly_metrics(t.v2())


add("monthly_metrics", _monthly)


add(
    "monthly_metrics_filled",
    lambda t: timeseries.monthly_metrics(t.v2(), fill_missing=True).select("month", "total_trips", "total_revenue"),
)
add("monthly_lag", lambda t: timeseries.monthly_lag(_monthly(t)))
add("month_growth", lambda t: rounded(timeseries.month_growth(timeseries.monthly_lag(_monthly(t)))))
add("moving_average_3", lambda t: rounded(timeseries.moving_average(_monthly(t))))
add("trend_regression", lambda t: rounded(timeseries.trend_regression(_monthly(t)), 5))
add("seasonal_decompose", lambda t: rounded(timeseries.seasonal_decompose(_monthly(t))))
add(
    "location_unit_roots",
    lambda t: rounded(timeseries.unit_roots(zones.daily_location_rollup(t.v1()), "trip_count", "date", ["pu_location_id"])),
)
add("adf_statistic", lambda t: rounded(timeseries.adf_statistic(_monthly(t))))

# ---------------------------------------------------------------- order, limits, sets

add(
    "order_by_label",
    lambda t: frequency(t.v2(), "time_of_day").withColumn(
        "label_rank", C.label_rank("time_of_day", profiles.ORDER_V2)
    ).orderBy("label_rank"),
)


@register("top_n_by")
def _(t: Tables) -> DataFrame:
    pairs = catalog.REPORTS_V2["view_geographic"](t.v2()).select(
        "pickup_location_id", "dropoff_location_id", "trip_count"
    )
    return sampling.top_n_by(pairs, "trip_count", 25, ["pickup_location_id", "dropoff_location_id"])


_SCATTER = ("trip_id", "trip_distance", "trip_duration_minutes", "total_amount", "time_of_day")
add("limit_rows", lambda t: sampling.limit_rows(t.v2(), 10_000).select(*_SCATTER))
add("sample_n", lambda t: sampling.sample_n(t.v2()).select("trip_id", "trip_distance", "speed_mph", "time_of_day"))


@register("union_months")
def _(t: Tables) -> DataFrame:
    v2 = t.v2()
    months = [v2.where(F.col("pickup_month") == m) for m in range(1, 13)]
    return _month_totals(tables.union_tables(months))


@register("wildcard_union")
def _(t: Tables) -> DataFrame:
    v2 = t.v2()
    years = [v2.where(F.col("pickup_year") <= 1997), v2.where(F.col("pickup_year") > 1997)]
    return rounded(catalog.REPORTS_V2["view_trip_volume"](tables.union_tables(years)))


# ---------------------------------------------------------------- statistics

add("describe_numeric", lambda t: rounded(stats.describe_numeric(t.v2()), 5))
add("basic_stats", lambda t: rounded(stats.basic_stats(t.v2())))
add("distribution_stats", lambda t: rounded(stats.distribution_stats(t.v2())))
add("correlation_matrix", lambda t: rounded(stats.correlation_matrix(t.v2())))
add("correlation_all_numeric", lambda t: rounded(stats.correlation_all_numeric(t.v2())))
add("weekend_ttest", lambda t: rounded(stats.weekend_ttest(t.v2())))
add(
    "t_pvalue",
    lambda t: rounded(stats.weekend_ttest(t.v2(), by=["pickup_location_id"])).select(
        "pickup_location_id", "t_statistic", "degrees", "p_value"
    ),
)
add(
    "five_number_summary",
    lambda t: rounded(stats.five_number_summary(t.v2(), "total_amount", ["time_of_day"], few_groups=True)),
)
add(
    "five_number_summary_by_payment",
    lambda t: rounded(stats.five_number_summary(t.v2(), "total_amount", ["payment_type"])),
)
add("violin_density", lambda t: rounded(stats.density(t.v2(), "total_amount", ["is_weekend"], few_groups=True)))
add("histogram_bins", lambda t: rounded(stats.histogram_bins(t.v2(), "cost_per_mile")))
add("auto_histogram", lambda t: rounded(stats.auto_histogram(t.v2())))
add("ols_trend_line", lambda t: rounded(stats.ols_trend_line(t.v2())))
add("zscore_profile", lambda t: rounded(stats.zscore_profile(catalog.REPORTS_V2["radar_profile"](t.v2()))))
add("location_clusters", lambda t: rounded(cluster.location_clusters(catalog.REPORTS_V2["location_profile"](t.v2()))))
add("null_profile", lambda t: stats.null_profile(t.v1().drop("trip_id")))
add("value_ranges", lambda t: rounded(stats.value_ranges(t.v2())))

# ---------------------------------------------------------------- quality

add("dq_counts", lambda t: quality.dq_counts(t.v2()))
add("dq_assertions", lambda t: quality.dq_assertions(quality.dq_counts(t.v2())))
add("record_count_bounds", lambda t: quality.record_count_bounds(quality.dq_counts(t.v2())))
add("success_rate", lambda t: rounded(quality.success_rate(t.raw(), clean.standard_rules())))
add("min_count_check", lambda t: quality.min_count_check(t.v2()))


@register("run_metrics")
def _(t: Tables) -> DataFrame:
    path = t.shared("runs")
    row = quality.run_metrics(quality.dq_counts(t.v2()), "run", flow="analytics")
    quality.append_run_metrics(row, path)
    return t.spark.read.parquet(path).drop("recorded_at")


@register("flow_run_metrics")
def _(t: Tables) -> DataFrame:
    """Metrics of a run as its own writing job observed them."""
    root, path = _delivered(t), t.shared("flow-runs")
    months = processing.present_months(t.spark, root)
    raw = files.scan_deliveries(t.spark, root, months=months, task_bytes=processing.TASK_BYTES)
    run = processing.run_flow(raw, t.shared("published"), "trips", processing.derive_v1, {}, months, spread=False)
    quality.append_run_metrics(quality.run_row(t.spark, run.metrics), path)
    return t.spark.read.parquet(path).drop("recorded_at", "run_id", "seconds", "success_rate")


add("reject_reasons", lambda t: clean.reject_reasons(t.raw(), clean.standard_rules()))

# ---------------------------------------------------------------- streams


@register("stream_land_files")
def _(t: Tables) -> DataFrame:
    source, out = t.shared("arrivals"), t.shared("landed")
    raw = t.raw()
    raw.write.parquet(source)
    landing.stream_land_files(t.spark, source, raw.schema, out, t.shared("landed-log")).awaitTermination()
    return rounded(catalog.REPORTS_V1["viz_hourly_patterns"](t.spark.read.parquet(out)))


@register("stream_replace_months")
def _(t: Tables) -> DataFrame:
    """Half of the trips, then in later triggers a newer delivery of all of them, in two parts."""
    source, out, log = t.shared("deliveries"), t.shared("replaced"), t.shared("replaced-log")
    raw = t.raw_by_month()
    months = {"file_year": F.coalesce(F.year("tpep_pickup_datetime"), F.lit(1900)), "file_month": F.coalesce(F.month("tpep_pickup_datetime"), F.lit(1))}
    odd = F.coalesce(F.xxhash64("trip_id") % 2 != 0, F.lit(False))
    for folder, part in (("first", odd), ("second", ~odd), ("second", None)):
        # the rows of the last part are those of the first, which lie by month there
        some = raw.where(part).withColumns(months) if part is not None else _months_of(t.spark, f"{source}/first", raw.schema)
        some.write.mode("append").option("compression", "zstd").partitionBy(*months).parquet(f"{source}/{folder}")
        landing.stream_replace_months(t.spark, source, raw.schema, out, log).awaitTermination()
    return rounded(catalog.REPORTS_V1["viz_hourly_patterns"](t.spark.read.parquet(out)))


def _months_of(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored rows with the year and month of their folders."""
    months = [T.StructField(name, T.IntegerType()) for name in processing.FILE_MONTH]
    return spark.read.schema(T.StructType([*schema.fields, *months])).parquet(path)


@register("stream_land_batches")
def _(t: Tables) -> DataFrame:
    """A backlog of eight files landed in several batches, then compacted."""
    source, out = t.shared("backlog"), t.shared("batches")
    raw = t.raw()
    # tasks of a large table go together without a shuffle
    wide = t.given("lineitem").rdd.getNumPartitions() >= 8
    (raw.coalesce(8) if wide else raw.repartition(8, "trip_id")).write.parquet(source)
    landing.stream_land_batches(t.spark, source, raw.schema, out, t.shared("batches-log"), max_bytes=1 << 20).awaitTermination()
    landing.compact_batches(t.spark, out)
    return rounded(catalog.REPORTS_V1["viz_hourly_patterns"](publish.Publication(t.spark, out).read("trips")))


#: Days of the events that arrive with the first and up to the second trigger, and days of which late rows are held back.
EVENT_DAYS, LATE_DAYS = (10, 20), 4


def _dropped_events(t: Tables) -> dict[str, int]:
    """What hourly counts behind the watermark leave out of events that arrive in three triggers, some twice and some far too late."""
    events, source = t.given("events"), t.shared("arrivals")
    first = events.agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("first")).first()["first"]
    day = F.datediff(F.col("ts").cast("date"), F.lit(first.date()))
    late = (F.col("event_id") % 50 == 7) & (day < LATE_DAYS)
    second = (day >= EVENT_DAYS[0]) & (day < EVENT_DAYS[1])
    arrivals = (
        events.where((day < EVENT_DAYS[0]) & ~late),
        events.where(second).unionByName(events.where(second & (F.col("event_id") % 10 == 0))),
        events.where((day >= EVENT_DAYS[1]) | late),
    )
    out, log, dropped = t.shared("hours"), t.shared("hours-log"), {"input_rows": 0, "late_rows": 0, "repeated_rows": 0}
    for number, arrived in enumerate(arrivals):
        arrived.write.parquet(f"{source}/{number}")
        stream = t.spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(source)
        query = windows.write_counts(windows.hourly_counts(stream, "ts", value="value", distinct=["event_id"]), out, log, "append")
        query.awaitTermination()
        dropped = {name: n + dropped[name] for name, n in windows.dropped_rows(query).items()}
    return dropped


@register("stream_hourly_counts")
def _(t: Tables) -> DataFrame:
    """Every event in its hour, open hours included."""
    out = t.shared("hours")
    # as a pattern, the name may be that of a single file, which a stream's plain path may not
    stream = t.spark.readStream.schema(t.given("events").schema).parquet(f"{t.folder}/events.parque[t]")
    counts = windows.hourly_counts(stream, "ts", value="value", undated=True)
    windows.write_counts(counts, out, t.shared("hours-log")).awaitTermination()
    return rounded(t.spark.read.parquet(out).withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz")))


@register("stream_dropped_rows")
def _(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([_dropped_events(t)], "input_rows bigint, late_rows bigint, repeated_rows bigint")


# ---------------------------------------------------------------- flows

def _delivered(t: Tables) -> str:
    """The raw trips as delivered month folders."""
    root = t.shared("delivered")
    months = {"file_year": F.year("tpep_pickup_datetime"), "file_month": F.month("tpep_pickup_datetime")}
    writers.write_partitioned(t.raw_by_month().withColumns(months), root, processing.FILE_MONTH, replace="all", spread=False)
    return root


def _stored_months(trips: DataFrame) -> DataFrame:
    return trips.groupBy(*processing.FILE_MONTH).agg(F.count(F.lit(1)).alias("trip_count"), F.sum("total_amount").alias("revenue"))


@register("process_v1")
def _(t: Tables) -> DataFrame:
    run = processing.process_v1_months(t.spark, _delivered(t), t.shared("published"))
    frames = {name: run.read(name) for name in catalog.METRIC_TABLES}
    return _long({**frames, "trips": _stored_months(run.read("trips"))}, processing.FILE_MONTH)


@register("process_v2")
def _(t: Tables) -> DataFrame:
    run = processing.process_v2_months(t.spark, _delivered(t), t.shared("published"))
    views = processing.published_views(t.spark, run, f"analytics_{run.metrics['run_id']}", suffix=f"_{run.metrics['run_id']}")
    return _long({name: t.spark.table(view) for name, view in zip(catalog.VISUAL_VIEWS, views)})


@register("process_v4")
def _(t: Tables) -> DataFrame:
    lookup = t.shared("lookup")
    t.zones().write.csv(lookup, header=True)
    run = processing.process_v4_months(t.spark, _delivered(t), lookup, t.shared("published"))
    frames = {name: run.read(name) for name in processing.STATISTICS}
    return _long({**frames, "trips": _stored_months(run.read("enriched"))}, processing.FILE_MONTH)


def builders() -> dict[str, Build]:
    return dict(_BUILDERS)


# Integer columns that hold nulls in some results.
_SPARSE_COUNTS = {
    "passenger_count": ("scan_parquet_schema", "fetch_month", "features_v2", "features_local"),
    "prev_month_trips": ("monthly_lag", "month_growth"),
}


def portable(name: str, df: DataFrame) -> DataFrame:
    """Types every client reads alike: dates as ISO text, integers with nulls as doubles."""
    casts = {f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, T.DateType)}
    casts |= {c: F.col(c).cast("double") for c, names in _SPARSE_COUNTS.items() if name in names}
    return df.withColumns(casts) if casts else df


def queries() -> dict[str, Query]:
    def bind(name: str, build: Build) -> Query:
        return lambda spark, folder: portable(name, build(Tables(spark, folder)))

    return {name: bind(name, build) for name, build in _BUILDERS.items()}
