"""Monthly series: metrics, growth, moving averages, trend and seasonality.

Windows here run over monthly aggregates, a row per month, optionally split by
series keys so that many series are processed in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tripmill.functions import columns as C
from tripmill.functions.pvalues import t_pvalue, unit_root_p
from tripmill.sources.calendar import month_range
from tripmill.sources.tables import month_span

# Measures of the monthly table and its trend report.
MONTHLY_AVERAGES = {
    "avg_fare": "total_amount",
    "avg_distance": "trip_distance",
    "avg_duration": "trip_duration_minutes",
    "avg_tip_percent": "tip_percentage",
}
TREND_METRICS = ("total_trips", "total_revenue", "avg_fare")
PERIOD = 12
# 5 % critical value of the unit-root statistic with a constant, by powers of 1 / observations.
UNIT_ROOT_CRITICAL = (-2.86154, -2.8903, -4.234, -40.04)
#: A regressor that the others explain but for this share of its variance counts as a combination of them.
DEPENDENT = 1e-10

YearMonth = tuple[int, int]


def monthly_metrics(
    df: DataFrame,
    first: YearMonth | None = None,
    last: YearMonth | None = None,
    by: Sequence[str] = (),
    fill_missing: bool = False,
) -> DataFrame:
    """Trips, revenue and averages per pickup month, two decimals.

    A month range prunes on the year and month columns. With ``fill_missing``
    months without trips get a row with zero trips.
    """
    if first and last:
        df = month_span(df, first, last)
    averages = [C.stable_round(F.avg(source), 2).alias(name) for name, source in MONTHLY_AVERAGES.items()]
    table = (
        df.groupBy(*by, C.month_start("pickup_year", "pickup_month").alias("month"))
        .agg(F.count(F.lit(1)).alias("total_trips"), C.stable_round(F.sum("total_amount"), 2).alias("total_revenue"), *averages)
    )
    if not fill_missing:
        return table
    bounds = table.groupBy(*by).agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    if first and last:
        bounds = bounds.withColumns(
            {"first_month": F.make_date(*map(F.lit, (*first, 1))), "last_month": F.make_date(*map(F.lit, (*last, 1)))}
        )
    steps = F.explode(F.sequence("first_month", "last_month", F.expr("INTERVAL 1 MONTH")))
    calendar = bounds.select(*by, steps.alias("month")) if by else month_range(bounds).select(
        F.col("month_start").alias("month")
    )
    return calendar.join(table, [*by, "month"], "left").fillna(0, ["total_trips"])


def _in_order(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*(by or [F.lit(0)])).orderBy("month")


def monthly_lag(monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trips and revenue of the previous row in month order."""
    order = _in_order(by)
    return monthly.withColumns(
        {
            "prev_month_trips": F.lag("total_trips").over(order),
            "prev_month_revenue": F.lag("total_revenue").over(order),
        }
    )


def month_growth(lagged: DataFrame) -> DataFrame:
    """Change against the previous month in percent."""
    def change(current: str, previous: str) -> Column:
        return C.ratio(F.col(current) - F.col(previous), previous, scale=100)

    return lagged.withColumns(
        {
            "trip_growth": change("total_trips", "prev_month_trips"),
            "revenue_growth": change("total_revenue", "prev_month_revenue"),
        }
    )


def moving_average(monthly: DataFrame, by: Sequence[str] = (), rows: int = 3) -> DataFrame:
    """Mean of the last ``rows`` months; null until that many values exist."""
    trailing = _in_order(by).rowsBetween(1 - rows, 0)

    def mean(name: str) -> Column:
        return F.when(F.count(name).over(trailing) == rows, F.avg(name).over(trailing))

    return monthly.withColumns(
        {f"trips_ma_{rows}": mean("total_trips"), f"revenue_ma_{rows}": mean("total_revenue")}
    )


def trend_table(monthly: DataFrame, metrics: Sequence[str] = TREND_METRICS, by: Sequence[str] = ()) -> DataFrame:
    """Line over the month index and summary statistics, a row per metric."""
    indexed = monthly.withColumn("_x", (F.row_number().over(_in_order(by)) - 1).cast("double"))
    values = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return (
        indexed.select(*by, "_x", F.inline(F.array(*values)))
        .groupBy(*by, "metric")
        .agg(
            F.regr_slope("value", "_x").alias("slope"),
            F.regr_r2("value", "_x").alias("r_squared"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.regr_count("value", "_x").alias("months"),
        )
    )


def trend_regression(monthly: DataFrame, metrics: Sequence[str] = TREND_METRICS, by: Sequence[str] = ()) -> DataFrame:
    """:func:`trend_table` with the p-value of each slope."""
    r2, degrees = F.col("r_squared"), F.col("months") - 2
    t = F.when(r2 >= 1, F.lit(float("inf"))).otherwise(F.sqrt(F.try_divide(r2 * degrees, 1 - r2)))
    return trend_table(monthly, metrics, by).withColumn("p_value", t_pvalue(t, degrees))


def seasonal_decompose(
    monthly: DataFrame, value: str = "total_trips", by: Sequence[str] = (), period: int = PERIOD
) -> DataFrame:
    """Additive decomposition into trend, seasonal and residual parts.

    The trend is a centred moving average over one period (half weights at
    both ends), extended to the ends by lines through the nearest ``period``
    trend values. Seasonal values are the phase means of the detrended series
    less their mean. Series shorter than two periods give nulls.
    """
    half = period // 2
    series = Window.partitionBy(*(by or [F.lit(0)]))
    order = series.orderBy("month")
    y = F.col(value).cast("double")
    base = monthly.select(*by, "month", y.alias("observed")).withColumns(
        {"_i": F.row_number().over(order) - 1, "_n": F.count(F.lit(1)).over(series)}
    )
    ends = F.lag("observed", half).over(order) + F.lead("observed", half).over(order)
    middle = F.sum("observed").over(order.rowsBetween(1 - half, half - 1))
    raw = F.when(F.col("_n") >= 2 * period, (middle + ends / 2) / period)
    trended = base.withColumn("_raw", raw)

    last = F.col("_n") - half - 1
    near_start = F.col("_i") < F.least(F.lit(half + period), last)
    near_end = (F.col("_i") >= F.greatest(F.lit(half), last - period)) & (F.col("_i") < last)

    def line(where: Column) -> Column:
        known = F.when(where, F.col("_raw"))
        slope = F.regr_slope(known, F.col("_i")).over(series)
        return F.regr_intercept(known, F.col("_i")).over(series) + slope * F.col("_i")

    extended = trended.withColumn(
        "trend",
        F.when(F.col("_i") < half, line(near_start)).when(F.col("_i") > last, line(near_end)).otherwise(F.col("_raw")),
    ).withColumns({"_phase": F.col("_i") % period, "_rest": F.col("observed") - F.col("trend")})
    phase = Window.partitionBy(*by, "_phase")
    means = extended.withColumns(
        {"_mean": F.avg("_rest").over(phase), "_times": F.count(F.lit(1)).over(phase)}
    )
    centre = F.sum(F.col("_mean") / F.col("_times")).over(series) / period
    return means.withColumn("seasonal", F.col("_mean") - centre).select(
        *by,
        "month",
        "observed",
        "trend",
        "seasonal",
        (F.col("_rest") - F.col("seasonal")).alias("residual"),
    )


def _least_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rest = y - x @ beta
    return beta, float(rest @ rest)


def unit_root_statistic(y: np.ndarray) -> tuple[float, int, int]:
    """Augmented unit-root statistic with a constant; lags chosen by AIC.

    Returns the statistic, the lags used and the observations of the final fit.
    """
    step = np.diff(y)
    limit = min(int(np.ceil(12 * (len(y) / 100) ** 0.25)), len(y) // 2 - 2)
    if limit < 0:
        return float("nan"), 0, 0

    def design(lags: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(first, len(step))
        parts = [np.ones(len(rows)), y[rows], *(step[rows - k] for k in range(1, lags + 1))]
        return np.column_stack(parts), step[rows]

    def information(lags: int) -> float:
        x, target = design(lags, limit)
        _, rest = _least_squares(x, target)
        return len(target) * np.log(max(rest, 1e-300) / len(target)) + 2 * x.shape[1]

    lags = min(range(limit + 1), key=information)
    x, target = design(lags, lags)
    beta, rest = _least_squares(x, target)
    spare = len(target) - x.shape[1]
    if spare <= 0 or rest <= 0:
        return float("nan"), lags, len(target)
    error = np.sqrt(rest / spare * np.linalg.pinv(x.T @ x)[1, 1])
    return float(beta[1] / error), lags, len(target)


def adf_statistic(monthly: DataFrame, value: str = "total_trips", by: Sequence[str] = ()) -> DataFrame:
    """Unit-root test per series: statistic, p-value, lags and observations.

    A group is the months of one series, already aggregated.
    """
    keys = list(by) or ["_series"]
    rows = monthly.withColumn("_series", F.lit(0)) if not by else monthly
    rows = rows.select(*keys, "month", F.col(value).cast("double").alias("_y")).where(F.col("_y").isNotNull())

    def test(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        statistic, lags, used = unit_root_statistic(group.sort_values("month")["_y"].to_numpy())
        known = np.isfinite(statistic)
        result = dict(zip(keys, key))
        result |= {
            "adf_statistic": statistic if known else None,
            "adf_pvalue": unit_root_p(statistic) if known else None,
            "used_lag": lags,
            "observations": used,
        }
        return pd.DataFrame([result])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    layout = ", ".join(f"`{k}` {types[k]}" for k in keys)
    tested = rows.groupBy(*keys).applyInPandas(
        test, f"{layout}, adf_statistic double, adf_pvalue double, used_lag int, observations int"
    )
    return tested if by else tested.drop("_series")


def unit_roots(rows: DataFrame, value: str, time: str, by: Sequence[str], lags: int = 1) -> DataFrame:
    """Unit-root test with a constant and a fixed number of lags, for many series at once.

    The steps of a series are regressed on the level before and on the ``lags``
    steps before. All products of these variables are gathered as covariances, which
    combine before the shuffle of groups, and are factored column by column (Cholesky) with
    the level and the step last: the statistic is the quotient of the two entries
    of the last row, scaled by the degrees of freedom.

    One row per series with ``observations`` (rows of the regression), ``statistic``
    and ``stationary`` (below the 5 % critical value). Steps lie between
    neighbouring rows, so a calendar with gaps is filled beforehand where gaps
    matter. Null and NaN values are left out; rows that repeat a time are ordered by value.
    The statistic is null where the series is too short, constant, or fits without a rest.
    A null key is a series of its own; a series without any value has no row.
    """
    order = Window.partitionBy(*by).orderBy(time, "_y")
    known = rows.select(*by, time, F.col(value).cast("double").alias("_y")).where(F.col("_y").isNotNull() & ~F.isnan("_y"))
    stepped = known.withColumn("_level", F.lag("_y").over(order)).withColumn("_step", F.col("_y") - F.col("_level"))
    before = [F.lag("_step", k).over(order).alias(f"_x{k - 1}") for k in range(1, lags + 1)]
    level, step = lags, lags + 1
    cells = stepped.select(*by, *before, F.col("_level").alias(f"_x{level}"), F.col("_step").alias(f"_x{step}"))
    complete = F.col(f"_x{lags - 1}" if lags else f"_x{step}").isNotNull()
    pairs = [(i, j) for i in range(step + 1) for j in range(i + 1)]
    table = cells.groupBy(*by).agg(
        F.count_if(complete).alias("observations"),
        *[F.covar_pop(F.when(complete, F.col(f"_x{i}")), F.when(complete, F.col(f"_x{j}"))).alias(f"_c{i}_{j}") for i, j in pairs],
    )
    for j in range(step + 1):
        rest = F.col(f"_c{j}_{j}") - sum((F.col(f"_l{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        table = table.withColumn(f"_l{j}_{j}", F.when(rest > DEPENDENT * F.col(f"_c{j}_{j}"), F.sqrt(rest)))
        below = {
            f"_l{i}_{j}": (F.col(f"_c{i}_{j}") - sum((F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"_l{j}_{j}")
            for i in range(j + 1, step + 1)
        }
        if below:
            table = table.withColumns(below)
    n = F.col("observations")
    spare = n - lags - 2
    statistic = F.when(spare > 0, F.col(f"_l{step}_{level}") / F.col(f"_l{step}_{step}") * F.sqrt(spare))
    critical = sum((F.lit(c) / n**power for power, c in enumerate(UNIT_ROOT_CRITICAL)), F.lit(0.0))
    return table.select(*by, "observations", statistic.alias("statistic")).withColumn("stationary", F.col("statistic") < critical)
