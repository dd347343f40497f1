"""Outliers by the interquartile range."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.quantiles import quantiles, spread
from tripmill.session import settle

# Metrics checked and width of the fences.
METRICS = ("total_amount", "trip_distance", "trip_duration_minutes", "speed_mph")
FENCE = 1.5


def with_fences(quartiles: DataFrame) -> DataFrame:
    reach = FENCE * (F.col("q3") - F.col("q1"))
    return quartiles.withColumns({"lower_bound": F.col("q1") - reach, "upper_bound": F.col("q3") + reach})


def fences_of(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The fences, from quantiles that hold the first and third quartile."""
    return with_fences(spread(found, {0.25: "q1", 0.75: "q3"}, by))


def iqr_fences(
    df: DataFrame,
    metrics: Sequence[str] = METRICS,
    by: Sequence[str] = (),
    approx: bool = False,
    few_groups: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Rows (by..., metric, q1, q3, lower_bound, upper_bound)."""
    found = quantiles(df, metrics, [0.25, 0.75], by, approx, few_groups, stored)
    return fences_of(found, by)


def _outside(df: DataFrame, metrics: Sequence[str], approx: bool, fences: DataFrame | None) -> dict[str, Column]:
    """Whether each metric lies outside its fences, which are a subquery evaluated once."""
    fences = iqr_fences(df, metrics, approx=approx, stored=True) if fences is None else fences
    limits = fences.agg(
        F.struct(
            *[
                F.max(F.when(F.col("metric") == m, F.struct(F.col("lower_bound").alias("low"), F.col("upper_bound").alias("high")))).alias(m)
                for m in metrics
            ]
        )
    ).scalar()
    values = {m: F.col(m).cast("double") for m in metrics}
    return {m: ~F.isnan(v) & ((v < limits.getField(m).getField("low")) | (v > limits.getField(m).getField("high"))) for m, v in values.items()}


def iqr_outliers(
    df: DataFrame, metrics: Sequence[str] = METRICS, keep: Sequence[str] = ("trip_id",), approx: bool = False, stored: bool = False, fences: DataFrame | None = None
) -> DataFrame:
    """Rows (keep..., metric, value) outside the fences of their metric; a row without outliers is left before any is made.

    The columns are stored first, as several passes read them, unless ``stored``
    states that ``df`` reads stored rows. ``fences`` are :func:`iqr_fences` of it if known.
    """
    df = df if stored or approx else settle(df.select(*dict.fromkeys([*keep, *metrics])), "outliers")
    outside = _outside(df, metrics, approx, fences)
    found = [F.when(o, F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))) for m, o in outside.items()]
    any_outside = reduce(Column.__or__, [F.coalesce(o, F.lit(False)) for o in outside.values()])
    return df.where(any_outside).select(*keep, F.inline(F.array_compact(F.array(*found))))


def iqr_outlier_counts(df: DataFrame, metrics: Sequence[str] = METRICS, approx: bool = False, stored: bool = False, fences: DataFrame | None = None) -> DataFrame:
    """Outliers per metric, counted in one aggregate; metrics without any are absent. See :func:`iqr_outliers`."""
    df = df if stored or approx else settle(df.select(*dict.fromkeys(metrics)), "outliers")
    counts = df.agg(*[F.count_if(o).alias(m) for m, o in _outside(df, metrics, approx, fences).items()])
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("anomaly_count")) for m in metrics]
    return counts.select(F.inline(F.array(*rows))).where("anomaly_count > 0")


def outlier_rows(df: DataFrame, metric: str, approx: bool = False, stored: bool = False) -> DataFrame:
    """Whole rows whose ``metric`` lies outside its fences; ``stored`` states that ``df`` reads stored rows."""
    bounds = iqr_fences(df, [metric], approx=approx, stored=stored).agg(
        F.struct(F.max("lower_bound").alias("low"), F.max("upper_bound").alias("high")).alias("bounds")
    )
    limits = bounds.scalar()
    return df.where((F.col(metric) < limits.getField("low")) | (F.col(metric) > limits.getField("high")))
