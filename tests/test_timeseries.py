from __future__ import annotations

from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripmill.functions import pvalues
from tripmill.operators import stats, timeseries
from tripmill.sources.calendar import month_range


def months(n: int, start: int = 0) -> list[date]:
    return [date(2000 + (start + i) // 12, (start + i) % 12 + 1, 1) for i in range(n)]


def series(spark, values, key: str | None = None):
    frame = pd.DataFrame({"month": months(len(values)), "total_trips": values, "total_revenue": values})
    frame["avg_fare"] = frame["total_trips"] * 2.0
    if key:
        frame.insert(0, "zone", key)
    return spark.createDataFrame(frame)


def decompose(y: np.ndarray, period: int = 12):
    """Straightforward reference: convolution, end lines, phase means."""
    half = period // 2
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(len(y), np.nan)
    trend[half:-half] = np.convolve(y, weights, "valid")
    last = len(y) - half - 1
    head = np.arange(half, min(half + period, last))
    tail = np.arange(max(half, last - period), last)
    trend[:half] = np.polyval(np.polyfit(head, trend[head], 1), np.arange(half))
    trend[last + 1 :] = np.polyval(np.polyfit(tail, trend[tail], 1), np.arange(last + 1, len(y)))
    phase = np.array([np.mean((y - trend)[i::period]) for i in range(period)])
    seasonal = np.tile(phase - phase.mean(), len(y) // period + 1)[: len(y)]
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("n", [24, 31, 60])
def test_decomposition(spark, n):
    rng = np.random.default_rng(n)
    y = 100 + 2.0 * np.arange(n) + 10 * np.sin(np.arange(n) * np.pi / 6) + rng.normal(0, 1, n)
    both = series(spark, y, "a").unionByName(series(spark, y[::-1], "b"))
    result = timeseries.seasonal_decompose(both, by=["zone"]).orderBy("zone", "month").toPandas()
    for key, data in (("a", y), ("b", y[::-1])):
        part = result[result.zone == key]
        for column, expected in zip(("trend", "seasonal", "residual"), decompose(data)):
            np.testing.assert_allclose(part[column].to_numpy(float), expected, atol=1e-8)


def test_short_series_gives_nulls(spark):
    rows = timeseries.seasonal_decompose(series(spark, np.arange(23.0))).collect()
    assert len(rows) == 23 and all(r.trend is None for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_moving_average(spark, n):
    rows = timeseries.moving_average(series(spark, np.arange(float(n)))).orderBy("month").collect()
    expected = pd.Series(np.arange(float(n))).rolling(3).mean()
    assert [r.trips_ma_3 for r in rows] == [None if np.isnan(v) else v for v in expected]


def test_lag_and_growth(spark):
    rows = timeseries.month_growth(timeseries.monthly_lag(series(spark, [100.0, 0.0, 50.0]))).orderBy("month").collect()
    assert [r.prev_month_trips for r in rows] == [None, 100.0, 0.0]
    assert [r.trip_growth for r in rows] == [None, -100.0, None]


def test_trend(spark):
    y = np.array([3.0, 5.0, 4.0, 8.0, 9.0, 11.0])
    row = timeseries.trend_regression(series(spark, y), ["total_trips"]).first()
    slope, _ = np.polyfit(np.arange(6), y, 1)
    assert row.slope == pytest.approx(slope)
    assert row.r_squared == pytest.approx(np.corrcoef(np.arange(6), y)[0, 1] ** 2)
    r = np.sqrt(row.r_squared)
    assert row.p_value == pytest.approx(float(pvalues.student_p(r * np.sqrt(4 / (1 - r**2)), 4)))
    perfect = timeseries.trend_regression(series(spark, np.arange(5.0)), ["total_trips"]).first()
    assert perfect.p_value == pytest.approx(0, abs=1e-6)


def test_month_range_crosses_december(spark):
    bounds = spark.createDataFrame([(date(2022, 11, 5), date(2023, 2, 1))], "first_month date, last_month date")
    rows = month_range(bounds).orderBy("month_start").collect()
    assert [(r.year, r.month) for r in rows] == [(2022, 11), (2022, 12), (2023, 1), (2023, 2)]


def test_missing_months_are_filled_on_request(spark):
    trips = spark.createDataFrame(
        [(2022, 11, 1.0), (2023, 1, 2.0), (2023, 1, 4.0), (2025, 1, 9.0)], "pickup_year int, pickup_month int, total_amount double"
    )
    for name in ("trip_distance", "trip_duration_minutes", "tip_percentage"):
        trips = trips.withColumn(name, F.col("total_amount"))
    span = ((2022, 11), (2023, 2))
    plain = timeseries.monthly_metrics(trips, *span)
    assert sorted(r.total_trips for r in plain.collect()) == [1, 2]
    filled = timeseries.monthly_metrics(trips, *span, fill_missing=True).orderBy("month").collect()
    assert [r.total_trips for r in filled] == [1, 0, 2, 0]
    assert filled[1].total_revenue is None


def test_unit_root_separates_walk_from_noise(spark):
    rng = np.random.default_rng(3)
    noise = rng.normal(0, 1, 200)
    both = series(spark, noise, "noise").unionByName(series(spark, np.cumsum(noise), "walk"))
    rows = {r.zone: r for r in timeseries.adf_statistic(both, by=["zone"]).collect()}
    assert rows["noise"].adf_pvalue < 0.01
    assert rows["walk"].adf_pvalue > 0.05


def test_unit_root_without_lags_by_hand():
    """With no lagged steps the statistic is the t value of the level in a plain regression."""
    y = np.array([1.0, 1.4, 0.9, 1.8])
    step, level = np.diff(y), y[:-1]
    centred = level - level.mean()
    slope = (centred @ step) / (centred @ centred)
    rest = step - step.mean() - slope * centred
    error = np.sqrt(rest @ rest / (len(step) - 2) / (centred @ centred))
    statistic, lags, used = timeseries.unit_root_statistic(y)
    assert (lags, used) == (0, 3)
    assert statistic == pytest.approx(slope / error)


@pytest.mark.parametrize("statistic, p", [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)])
def test_unit_root_critical_values(statistic, p):
    assert pvalues.unit_root_p(statistic) == pytest.approx(p, abs=0.002)


# Two-sided 5 % and 1 % points of the published t table.
@pytest.mark.parametrize("t, df, p", [(12.706, 1, 0.05), (2.228, 10, 0.05), (3.169, 10, 0.01), (1.960, 1e7, 0.05)])
def test_student_table(t, df, p):
    assert float(pvalues.student_p(t, df)) == pytest.approx(p, abs=2e-4)


def test_student_edges():
    assert pvalues.student_p([0.0, np.inf, np.nan], [5, 5, 5])[:2].tolist() == pytest.approx([1.0, 0.0])
    assert np.isnan(pvalues.student_p(np.nan, 5))


def test_ttest_by_hand(spark):
    rows = [(False, 1.0), (False, 2.0), (False, 3.0), (True, 4.0), (True, 6.0)]
    df = spark.createDataFrame(rows, "is_weekend boolean, total_amount double")
    row = stats.weekend_ttest(df).first()
    pooled = (2 * 1.0 + 1 * 2.0) / 3
    assert row.t_statistic == pytest.approx((2 - 5) / np.sqrt(pooled * (1 / 3 + 1 / 2)))
    assert row.degrees == 3


def test_moments_match_pandas(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"x": rng.gamma(2, 3, 500), "y": rng.normal(0, 1, 500)})
    data["z"] = data["x"] * 0.5 + data["y"]
    df = spark.createDataFrame(data)
    for row in stats.basic_stats(df, ["x", "y"]).collect():
        column = data[row.metric]
        assert row["mean"] == pytest.approx(column.mean())
        assert row["median"] == pytest.approx(column.median())
        assert row["std"] == pytest.approx(column.std())
        assert row["skew"] == pytest.approx(column.skew())
        assert row["kurtosis"] == pytest.approx(column.kurtosis())
    matrix = data.corr()
    for row in stats.correlation_all_numeric(df).collect():
        assert row.r == pytest.approx(matrix.loc[row.metric_a, row.metric_b])
    described = {r.metric: r for r in stats.describe_numeric(df).collect()}
    expected = data.describe()
    assert described["z"].q25 == pytest.approx(expected.loc["25%", "z"])
    assert described["z"]["count"] == 500


def test_constant_column_correlates_with_nothing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "c double, x double")
    r = {(x.metric_a, x.metric_b): x.r for x in stats.correlation_matrix(df, ["c", "x"]).collect()}
    assert r == {("c", "c"): None, ("c", "x"): None, ("x", "c"): None, ("x", "x"): 1.0}


@pytest.mark.parametrize("lags", [0, 1, 3])
def test_unit_roots_of_many_series_equal_least_squares(spark, lags):
    rng = np.random.default_rng(lags)
    noise = {name: rng.normal(1e6, 3, size) for name, size in (("a", 80), ("b", 40), ("c", 12))}
    made = noise | {"walk": np.cumsum(noise["a"] - 1e6), "flat": np.full(30, 7.0), "line": np.arange(20.0), "short": np.array([1.0, 5.0, 2.0])}
    frames = [pd.DataFrame({"zone": name, "day": months(len(y)), "y": y}) for name, y in made.items()]
    rows = spark.createDataFrame(pd.concat(frames)).repartition(5)
    gone = spark.createDataFrame([("a", months(1, 900)[0], None), ("none", months(1)[0], None)], rows.schema)
    found = {r.zone: r for r in timeseries.unit_roots(rows.unionByName(gone), "y", "day", ["zone"], lags).collect()}
    assert set(found) == set(made)
    for name, y in made.items():
        step = np.diff(y)
        at = np.arange(lags, len(step))
        assert found[name].observations == max(0, len(at))
        if name in ("flat", "line", "short"):
            assert found[name].statistic is None and found[name].stationary is None
            continue
        x = np.column_stack([np.ones(len(at)), y[at] - y.mean(), *(step[at - k] for k in range(1, lags + 1))])
        beta, *_ = np.linalg.lstsq(x, step[at], rcond=None)
        rest = step[at] - x @ beta
        error = np.sqrt(rest @ rest / (len(at) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
        assert found[name].statistic == pytest.approx(beta[1] / error, rel=1e-6)
    assert found["a"].stationary and not found["walk"].stationary
    assert timeseries.unit_roots(rows.limit(0), "y", "day", ["zone"], lags).count() == 0
