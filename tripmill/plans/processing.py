"""Composed flows: scan, clean, derive, store, report.

A flow stores the derived trips first and computes its reports from the stored
table. Reports then read columns instead of repeating the chain, and a lost
executor costs a re-read, not a re-derivation.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import columns as C
from tripmill.functions import features, profiles
from tripmill.operators import bundles, clean, outliers, quality, stats, timeseries, zones
from tripmill.operators.quantiles import quantiles
from tripmill.operators.reports import COUNT, Report
from tripmill.operators.sampling import limit_rows
from tripmill.plans import catalog
from tripmill.session import settle
from tripmill.sources import files, tables, writers
from tripmill.sources.publish import Publication, PublicationError, new_run_id
from tripmill.sources.writers import ANALYTICS_CLUSTER, DAY_CLUSTER, DAY_PARTITION

FILE_MONTH = ("file_year", "file_month")
#: Bytes of delivered files that a task reads where rows are stored without a shuffle.
TASK_BYTES = 48 << 20
#: Statistics of the enriched flow and the reports they are.
STATISTICS = {"overall": "overall_stats", "by_borough": "borough_stats", "by_time": "time_stats", "popular_routes": "popular_routes"}


def derive_v1(raw: DataFrame) -> DataFrame:
    """Cleaned trips with the V1 feature columns."""
    return features.add_features(clean.clean_trips(raw), profiles.V1)


def derive_v2(raw: DataFrame) -> DataFrame:
    """Trips with the V2 feature columns; no cleaning step belongs to this flow."""
    return features.add_features(tables.to_analytics_names(raw), profiles.V2)


def derive_v4(raw: DataFrame, zone_lookup: DataFrame) -> DataFrame:
    """Outlier-free trips with zones and the V4 feature columns."""
    return zones.zone_enrich_features(clean.clean_trips_p99(raw), zone_lookup)


def trip_metrics(processed: DataFrame) -> dict[str, DataFrame]:
    """The four metric tables; the columns they read are stored once."""
    return _apart(processed, metric_reports())


def trip_statistics(enriched: DataFrame) -> dict[str, DataFrame]:
    """Overall, borough, time-of-day and route statistics; the columns they read are stored once."""
    return _apart(enriched, statistic_reports())


def metric_reports() -> dict[str, Report]:
    return {name: catalog.REPORTS_V1[name] for name in catalog.METRIC_TABLES}


def statistic_reports() -> dict[str, Report]:
    return {label: catalog.REPORTS_V4[name] for label, name in STATISTICS.items()}


def _apart(trips: DataFrame, reports: Mapping[str, Report]) -> dict[str, DataFrame]:
    return bundles.bundle_apart(settle(trips.select(*bundles.columns_of(reports)), "measured"), reports)


def _cells(cells: DataFrame) -> DataFrame:
    return settle(cells, "cells")


def counted(column: str) -> Report:
    """Rows per value; a null value counts as a value of its own here."""
    return Report((column,), {"row_count": COUNT}, order=("-row_count", column))


EDA_REPORTS: dict[str, Report] = {
    "hourly_patterns": catalog.REPORTS_V2["trips_by_hour"],
    "daily_patterns": catalog.REPORTS_V2["trips_by_dayofweek"],
    "weekend_vs_weekday": catalog.REPORTS_V2["trips_by_weekend"],
    "payment_distribution": counted("payment_type"),
    "distance_categories": counted("trip_distance_category"),
    "means_by_time": catalog.REPORTS_V2["mean_by_time"],
}
#: Parts in which a null value is left out.
WITHOUT_NULLS = {"payment_distribution": "payment_type", "distance_categories": "trip_distance_category"}


def eda_summary(trips: DataFrame, quartiles: DataFrame | None = None) -> dict[str, DataFrame]:
    """Basic, temporal, financial and distance summaries of stored trips; all but the quartiles come from one scan."""
    found = bundles.bundle(trips, EDA_REPORTS, _cells)
    found = {name: f.where(F.col(WITHOUT_NULLS[name]).isNotNull()) if name in WITHOUT_NULLS else f for name, f in found.items()}
    return {"basic_stats": stats.describe_numeric(trips, stored=True, quartiles=quartiles), **found}


def eda_run(trips: DataFrame) -> dict[str, DataFrame]:
    """Every dataset of the exploratory run over stored trips, lazily but for the quartiles, which its parts share."""
    quartiles = quantiles(trips, list(dict.fromkeys([*stats.numeric_columns(trips), *outliers.METRICS])), [0.25, 0.5, 0.75], stored=True)
    fences = outliers.fences_of(quartiles)
    return {
        **eda_summary(trips, quartiles),
        "distributions": stats.distribution_stats(trips, stored=True, quartiles=quartiles),
        "correlations": stats.correlation_all_numeric(trips),
        "fares_by_time": stats.five_number_summary(trips, "total_amount", ["time_of_day"], few_groups=True),
        "anomalies": outliers.iqr_outliers(trips, stored=True, fences=fences),
        "anomaly_counts": outliers.iqr_outlier_counts(trips, stored=True, fences=fences),
        "top_pickups": catalog.value_counts(trips, "pickup_location_id", 10),
        "record_count": trips.agg(F.count(F.lit(1)).alias("record_count")),
    }


BUNDLE_REPORTS: dict[str, Report] = {
    name: catalog.REPORTS_V2[name]
    for name in (
        "hourly_demand", "payment_patterns", "trip_distance_analysis", "rush_hour_impact", "weekday_weekend_comparison",
        "revenue_by_location", "radar_profile", "hour_day_counts",
    )
}


def analysis_bundle(trips: DataFrame, scatter_rows: int = 10_000) -> dict[str, DataFrame]:
    """Every dataset of the analysis run, lazily; ``scatter_rows`` bounds the points of the scatter chart alone.

    The grouped reports, peak hours, radar profile and heat map come from one scan.
    """
    monthly = timeseries.monthly_lag(timeseries.monthly_metrics(trips))
    found = bundles.bundle(trips, BUNDLE_REPORTS | {"hourly_counts": catalog.HOURLY_COUNTS}, _cells)
    radar, by_hour_and_day = found.pop("radar_profile"), found.pop("hour_day_counts")
    return {
        "peak_hours": catalog.with_demand_level(found.pop("hourly_counts")),
        **found,
        "summary": catalog.summary_report(trips),
        "monthly": timeseries.moving_average(timeseries.month_growth(monthly)),
        "trend": timeseries.trend_regression(monthly),
        "heatmap": catalog.heatmap_of(by_hour_and_day),
        "fare_boxes": stats.five_number_summary(trips, "total_amount", ["time_of_day"], few_groups=True),
        "scatter": limit_rows(trips, scatter_rows).select("trip_distance", "trip_duration_minutes", "total_amount", "time_of_day"),
        "trend_lines": stats.ols_trend_line(trips),
        "radar": stats.zscore_profile(radar),
        "correlations": stats.correlation_matrix(trips),
        "basic_stats": stats.basic_stats(trips, stored=True),
        "weekend_ttest": stats.weekend_ttest(trips),
    }


@dataclass(frozen=True)
class FlowRun:
    """What a flow published: the tables below one root, the version, and one row of run metrics."""

    tables: Publication
    version: int
    metrics: dict

    def read(self, table: str) -> DataFrame:
        return self.tables.read(table)


def run_flow(
    raw: DataFrame,
    out: str,
    trips: str,
    derive: Callable[[DataFrame], DataFrame],
    reports: Mapping[str, Report],
    months: Sequence[tuple[int, int]],
    cluster: Sequence[str] = (),
    limits: quality.Limits | None = None,
    times: tuple[str, str] = ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    run_id: str | None = None,
    spread: bool = True,
) -> FlowRun:
    """Derive, store and report the given months of ``raw``, then publish all tables of the run in one step.

    ``raw`` has file_year and file_month. The writing job itself counts rows read,
    rows stored and the values that the gates look at. Reports are computed from the
    stored trips, one scan for those with common keys, for each file month, and have to account for
    every trip. Without ``spread`` rows of ``raw`` lie by file month, ``derive`` leaves
    them there, and they are stored without a shuffle. With ``limits``, a run outside them raises :class:`QualityError` and
    leaves what is published as it was.
    """
    spark, run_id, began = raw.sparkSession, run_id or new_run_id(), time.time()
    tables = Publication(spark, out)
    read, rows_read = Observation(f"read-{run_id}"), {"rows_read": F.count(F.lit(1))}
    derived = derive(raw.observe(read, *[column.alias(name) for name, column in rows_read.items()]))
    measures = {name: column for name, column in quality.count_columns(*times).items() if name != "record_count"}
    stored = tables.stage(derived, trips, run_id, FILE_MONTH, cluster, measures, spread)
    counts = {**writers.observed(read, raw, rows_read), "record_count": stored.observed["rows"], **{name: stored.observed[name] for name in measures}}
    failed = quality.failed_gates(counts, limits) if limits else []
    if failed:
        raise quality.QualityError("; ".join(failed))
    monthly = {name: bundles.per_part(report, FILE_MONTH) for name, report in reports.items()}
    found = bundles.bundle_apart(tables.staged(stored), monthly)
    staged = [stored]
    for name, frame in found.items():
        rows = next(column for column, measure in reports[name].measures.items() if measure == COUNT)
        kept = bundles.top_within(frame, reports[name], FILE_MONTH)
        staged.append(tables.stage(kept, name, run_id, FILE_MONTH, measures={"trips": F.coalesce(F.sum(rows), F.lit(0))}))
        if reports[name].top is None and staged[-1].observed["trips"] != counts["record_count"]:
            raise PublicationError(f"{name} accounts for {staged[-1].observed['trips']} of {counts['record_count']} trips")
    version = tables.publish(staged, [f"file_year={year}/file_month={month}" for year, month in months])
    metrics = {"run_id": run_id, "table_name": trips, "version": version, "months": len(months), "seconds": time.time() - began, **counts}
    return FlowRun(tables, version, metrics)


def month_literals(raw: DataFrame, year: int, month: int) -> DataFrame:
    return raw.withColumns({"file_year": F.lit(year), "file_month": F.lit(month)})


def present_months(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """The months that have a folder below ``root``."""
    found = [re.search(r"/file_year=(\d+)/file_month=(\d+)$", folder) for folder in files.delivery_folders(spark, root)]
    return [(int(m[1]), int(m[2])) for m in found if m]


def process_v1_months(spark: SparkSession, root: str, out: str, months: Sequence[tuple[int, int]] | None = None, keep: Sequence[str] = (), **options) -> FlowRun:
    """Delivered month folders, all or some, to published trips and the four metric tables of each month."""
    months = present_months(spark, root) if months is None else list(months)
    raw = files.scan_deliveries(spark, root, keep=keep, months=months, task_bytes=TASK_BYTES)
    return run_flow(raw, out, "trips", derive_v1, metric_reports(), months, (*DAY_PARTITION, *DAY_CLUSTER), spread=False, **options)


def process_v1(spark: SparkSession, input_path: str, out: str, year: int, month: int, **options) -> FlowRun:
    """One month file to published trips plus the four metric tables; other months stay."""
    raw = month_literals(files.scan_raw_trips(spark, input_path), year, month)
    return run_flow(raw, out, "trips", derive_v1, metric_reports(), [(year, month)], (*DAY_PARTITION, *DAY_CLUSTER), **options)


def visual_views(spark: SparkSession, processed: DataFrame, suffix: str = "") -> list[str]:
    """Temporary views over the V1 trip table."""
    return _register(spark, processed, catalog.REPORTS_V1, catalog.VISUAL_VIEWS, suffix)


def dashboard_views(spark: SparkSession, trips: DataFrame, suffix: str = "") -> list[str]:
    """Temporary views over the analytics trip table."""
    return _register(spark, trips, catalog.REPORTS_V2, catalog.DASHBOARD_VIEWS, suffix)


def _register(spark: SparkSession, df: DataFrame, reports: dict, names: Sequence[str], suffix: str) -> list[str]:
    views = [f"{name}{suffix}" for name in names]
    for view, name in zip(views, names):
        writers.create_view(spark, view, reports[name](df))
    return views


def as_v1_columns(trips: DataFrame) -> DataFrame:
    """Analytics trips with the columns the visual views read under their V1 names."""
    renamed = trips.withColumnsRenamed(
        {"trip_distance_category": "distance_category", "pickup_location_id": "pu_location_id"}
    )
    code = F.col("payment_type").try_cast("int")
    described = C.lookup(code, profiles.PAYMENT_LABELS, profiles.PAYMENT_UNKNOWN)
    return renamed.withColumns({"payment_type_desc": described, "is_weekend": F.col("is_weekend").cast("int")})


def process_v2_months(spark: SparkSession, root: str, out: str, months: Sequence[tuple[int, int]] | None = None, **options) -> FlowRun:
    """Delivered month folders, all or some, to the published analytics table; views read it (:func:`published_views`)."""
    months = present_months(spark, root) if months is None else list(months)
    raw = files.scan_deliveries(spark, root, keep=("trip_id",), months=months, task_bytes=TASK_BYTES)
    options = {"times": ("pickup_datetime", "dropoff_datetime"), "spread": False, **options}
    return run_flow(raw, out, "analytics", derive_v2, {}, months, ("pickup_date", *ANALYTICS_CLUSTER), **options)


def published_views(spark: SparkSession, run: FlowRun, table: str, months: Sequence[tuple[int, int]] | None = None, suffix: str = "") -> list[str]:
    """The analytics table as a temporary view and the visual views over it, or over some months of it."""
    run.read("analytics").createOrReplaceTempView(table)
    parts = None if months is None else [f"file_year={year}/file_month={month}" for year, month in months]
    return visual_views(spark, as_v1_columns(run.tables.read("analytics", parts)), suffix)


def process_v2(spark: SparkSession, root: str, table: str, out: str, year: int, month: int, **options) -> DataFrame:
    """One month of a month-partitioned lake to the published analytics table, then the visual views of that month.

    Other months of the analytics table stay; returns the whole table.
    """
    raw = files.rename_spellings(tables.month_slice(files.scan_parquet(spark, root), year, month).drop("pickup_year", "pickup_month"))
    options = {"times": ("pickup_datetime", "dropoff_datetime"), **options}
    run = run_flow(month_literals(raw, year, month), out, "analytics", derive_v2, {}, [(year, month)], ("pickup_date", *ANALYTICS_CLUSTER), **options)
    published_views(spark, run, table, [(year, month)], f"_{year}_{month:02d}")
    return run.read("analytics")


def process_v4_months(
    spark: SparkSession, root: str, zone_path: str, out: str, months: Sequence[tuple[int, int]] | None = None, keep: Sequence[str] = (), **options
) -> FlowRun:
    """Delivered month folders and the zone CSV to published enriched trips and the statistics of each month.

    The outlier limits are percentiles of everything the run reads.
    """
    months = present_months(spark, root) if months is None else list(months)
    raw = files.scan_deliveries(spark, root, keep=keep, months=months, task_bytes=TASK_BYTES)
    # joins with a lookup that every task holds leave rows where they are
    options = {"spread": not zones.fits_broadcast(files.scan_zones(spark, zone_path)), **options}
    return _flow_v4(spark, raw, zone_path, out, months, **options)


def process_v4(spark: SparkSession, input_path: str, zone_path: str, out: str, year: int, month: int, **options) -> FlowRun:
    """One month file and the zone CSV to published enriched trips plus their statistics."""
    raw = month_literals(files.scan_raw_trips(spark, input_path), year, month)
    return _flow_v4(spark, raw, zone_path, out, [(year, month)], **options)


def _flow_v4(spark: SparkSession, raw: DataFrame, zone_path: str, out: str, months: Sequence[tuple[int, int]], **options) -> FlowRun:
    lookup = files.scan_zones(spark, zone_path)
    limits = clean.percentile_limits(raw, ("trip_distance", "total_amount"), clean.OUTLIER_PERCENTILE)

    def derive(trips: DataFrame) -> DataFrame:
        return zones.zone_enrich_features(trips.where(clean.keep_if(clean.outlier_rules(limits))), lookup)

    return run_flow(raw, out, "enriched", derive, statistic_reports(), months, **options)


def quality_report(trips: DataFrame) -> DataFrame:
    """All count-based gates of an analytics table as pass/fail rows."""
    counts = quality.dq_counts(trips)
    return quality.dq_assertions(counts).unionByName(quality.record_count_bounds(counts))
