from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripmill.operators import quantiles as Q
from tripmill.operators.outliers import iqr_outlier_counts, iqr_outliers, outlier_rows
from tripmill.operators.stats import auto_histogram, basic_stats, correlation_matrix, density, describe_numeric, distribution_stats, five_number_summary, histogram_bins

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def found(df):
    return {tuple(r[:-1]): r[-1] for r in df.collect()}


@pytest.mark.parametrize("size", [1, 2, 3, 100, 9_999, 60_000])
def test_matches_numpy(spark, size):
    rng = np.random.default_rng(size)
    data = np.round(rng.lognormal(3, 2, size), 3)
    result = found(Q.exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": data})), ["x"], PROBS))
    for p in PROBS:
        assert result[("x", p)] == pytest.approx(np.quantile(data, p), rel=1e-12)


def test_hot_value_and_groups(spark):
    """A third of all rows share one value and one group; another group has one row."""
    rng = np.random.default_rng(7)
    hot = pd.DataFrame({"g": "hot", "x": np.where(np.arange(60_000) % 2, 5.0, rng.normal(5, 100, 60_000))})
    cold = pd.DataFrame({"g": rng.choice(list("abc"), 30_000), "x": rng.exponential(1, 30_000)})
    lone = pd.DataFrame({"g": [None], "x": [1.5]})
    data = pd.concat([hot, cold, lone])
    for few in (True, False):
        result = found(Q.exact_quantiles(spark.createDataFrame(data, "g string, x double"), ["x"], PROBS, ["g"], few))
        for g, part in data.groupby("g", dropna=False):
            key = None if pd.isna(g) else g
            for p in PROBS:
                assert result[(key, "x", p)] == pytest.approx(np.quantile(part["x"], p), rel=1e-12)


def test_far_outlier_does_not_break_buckets(spark):
    data = np.append(np.arange(50_000) / 1000, 1e15)
    result = found(Q.exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": data})), ["x"], [0.5, 0.999]))
    assert result[("x", 0.5)] == pytest.approx(np.quantile(data, 0.5))
    assert result[("x", 0.999)] == pytest.approx(np.quantile(data, 0.999))


def test_nulls_and_nans_are_skipped(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), 2.0), (3.0, None)], "x double, y double")
    assert found(Q.exact_quantiles(df, ["x", "y"], [0.5])) == {("x", 0.5): 2.0, ("y", 0.5): 2.0}


def test_approximate_has_the_same_shape(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert found(Q.quantiles(df, ["x"], [0.5], approx=True)) == {("x", 0.5): 500.0}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_task_orders_a_whole_group(spark):
    """Ranking windows are partitioned by bucket, and the built-in percentile is not used."""
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("g"))
    plan = plan_of(Q.exact_quantiles(df, ["x"], [0.5], ["g"]))
    assert "percentile(" not in plan
    assert "_bucket" in plan


def test_whole_tables_are_not_expanded(spark, tmp_path):
    """Counts of outliers and limits come from wide aggregates: no row is made above the scan."""
    path = str(tmp_path / "t")
    spark.range(3000).selectExpr("cast(id as string) AS trip_id", "id % 97 / 7.0 AS a", "id * 1.5 AS b").write.parquet(path)
    df = spark.read.parquet(path)
    counts = plan_of(iqr_outlier_counts(df, ["a", "b"]))
    assert "Generate" not in counts[counts.index("HashAggregate") :] and "Join" not in counts
    seen = []
    made = Q._Search("a", "a", {5}, 1.0, 3.0, 0, 3000, [0.0] * (Q.CUTS + 1))
    for narrowing in (True, False):
        made.within = 10**9 if narrowing else 10
        text = plan_of(df.agg(*made.counts("s"))) + plan_of(df.where(made.inside).agg(*made.rest("s", Q._spaced())))
        seen.append("percentile_approx" in text)
        assert "Generate" not in text and "Join" not in text and "Sort [" not in text
    assert seen == [True, False]


@pytest.mark.parametrize("cuts, last", [(8, 4), (32, 50)])
def test_narrowing_over_many_passes(spark, monkeypatch, cuts, last):
    """Few cuts and a small last step make many passes; ties, runs of one value and infinities included."""
    monkeypatch.setattr(Q, "CUTS", cuts)
    monkeypatch.setattr(Q, "LAST_VALUES", last)
    rng = np.random.default_rng(cuts)
    data = {
        "tied": rng.choice([1.0, 2.0, 2.5, 7.0], 5000),
        "spread": rng.lognormal(0, 3, 5000),
        "hot": np.where(np.arange(5000) % 3, 4.0, rng.normal(4, 1, 5000)),
        "same": np.full(5000, 3.25),
    }
    result = found(Q.exact_quantiles(spark.createDataFrame(pd.DataFrame(data)), list(data), PROBS))
    for name, values in data.items():
        for p in PROBS:
            assert result[(name, p)] == pytest.approx(np.quantile(values, p), rel=1e-12), (name, p)


def test_a_sketch_that_is_off_is_widened(spark, monkeypatch):
    """Cuts that miss the rank by far are noticed by the counts, and the interval is widened."""
    data = np.arange(3000) / 8
    df = spark.createDataFrame(pd.DataFrame({"x": data}))
    monkeypatch.setattr(Q, "LAST_VALUES", 20)
    real = Q._Search.narrow

    def off(self):
        real(self)
        if self.reach < 16:
            self.low, self.high = self.high + 3.0, self.high + 4.0

    monkeypatch.setattr(Q._Search, "narrow", off)
    assert found(Q.exact_quantiles(df, ["x"], [0.25]))[("x", 0.25)] == pytest.approx(np.quantile(data, 0.25))


def test_infinities_are_values(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),)], "x double")
    result = found(Q.exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]))
    assert result == {("x", 0.0): float("-inf"), ("x", 0.5): 1.5, ("x", 1.0): float("inf")}


def test_outliers(spark):
    values = [float(v) for v in range(100)] + [1000.0, -900.0]
    df = spark.createDataFrame([(str(i), v, 1.0) for i, v in enumerate(values)], "trip_id string, a double, b double")
    assert sorted(r.value for r in iqr_outliers(df, ["a", "b"]).collect()) == [-900.0, 1000.0]
    assert [tuple(r) for r in iqr_outlier_counts(df, ["a", "b"]).collect()] == [("a", 2)]
    assert outlier_rows(df, "b").count() == 0
    assert {r.a for r in outlier_rows(df, "a").collect()} == {-900.0, 1000.0}


def test_five_numbers(spark):
    df = spark.createDataFrame([("k", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, x double")
    row = five_number_summary(df, "x", ["g"], few_groups=True).first()
    assert (row.n, row.minimum, row.maximum, row.outliers) == (6, 1.0, 100.0, 1)
    assert (row.q1, row.median, row.q3) == (2.25, 3.5, 4.75)
    assert (row.lower_whisker, row.upper_whisker) == (1.0, 5.0)


def test_histogram_keeps_the_maximum(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    rows = histogram_bins(df, "x", 10).orderBy("bin").collect()
    assert [r.row_count for r in rows] == [10] * 9 + [11]
    assert (rows[0].bin_start, rows[-1].bin_end) == (0.0, 100.0)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    assert sum(r.row_count for r in histogram_bins(df, "x", 5).collect()) == 2


def test_density_integrates_to_about_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "x": rng.normal(0, 1, 5000)}))
    rows = density(df, "x", ["g"], points=200).orderBy("x").collect()
    area = np.trapezoid([r.density for r in rows], [r.x for r in rows])
    assert area == pytest.approx(1, abs=0.02)


def test_small_spread_is_not_flat(spark):
    """A column whose values differ little against their size still correlates; one that is constant does not."""
    rows = [(1_700_000_000_000.0 + i, float(i), 5.0, 2.0 if i < 5 else None, 1.0 if i < 5 else float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "big double, x double, same double, part double, y double")
    r = {(a, b): v for a, b, v in correlation_matrix(df, df.columns).collect()}
    assert r["big", "x"] == pytest.approx(1) and r["big", "big"] == 1
    assert r["same", "x"] is r["same", "same"] is r["part", "x"] is r["part", "y"] is None


def test_automatic_bins(spark):
    rng = np.random.default_rng(4)
    data = pd.DataFrame({"a": np.round(rng.gamma(2, 3, 4000), 2), "b": np.full(4000, 3.0)})
    rows = auto_histogram(spark.createDataFrame(data)).orderBy("metric", "bin").collect()
    counts, edges = np.histogram(data["a"], bins="auto")
    a = [r for r in rows if r.metric == "a"]
    assert {r.bin - 1: r.row_count for r in a} == {i: n for i, n in enumerate(counts.tolist()) if n}
    assert [r.bin_start for r in a] == pytest.approx([edges[r.bin - 1] for r in a]) and a[-1].bin_end == pytest.approx(edges[-1])
    assert sum(r.density * (r.bin_end - r.bin_start) for r in a) == pytest.approx(1)
    assert [(r.row_count, r.density) for r in rows if r.metric == "b"] == [(4000, None)]


@pytest.mark.parametrize(
    "run",
    [
        lambda df: Q.exact_quantiles(df, ["a", "b"], [0.25, 0.9]),
        lambda df: describe_numeric(df, ["a", "b"]),
        lambda df: basic_stats(df, ["a", "b"]),
        lambda df: distribution_stats(df, ["a", "b"]),
        lambda df: auto_histogram(df, ["a", "b"]),
        lambda df: iqr_outliers(df, ["a", "b"], ["id"]),
        lambda df: iqr_outlier_counts(df, ["a", "b"]),
    ],
)
def test_what_columns_are_made_from_is_done_once(spark, run):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(i):
        made.add(1)
        return float(i * i % 977)

    run(spark.range(3000).select("id", value("id").alias("a")).withColumn("b", F.col("a") + 1)).collect()
    assert made.value in (3000, 6000)  # once for each use in the row, in one pass


def test_ends_shared_by_ranks_and_repeated_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "LAST_VALUES", 5)
    values = [0.0] * 4000 + [float(i % 7) for i in range(3000)] + [float("inf")] * 50 + [float("-inf")] * 50
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "a double")
    probs = [0.0, 0.003, 0.01, 0.25, 0.5, 0.75, 0.8, 0.999, 1.0]
    found = {r.p: r.value for r in Q.exact_quantiles(df, ["a"], probs).collect()}
    ordered = sorted(values)
    for p in probs:
        position = (len(ordered) - 1) * p
        low, high = ordered[int(position)], ordered[min(int(position) + 1, len(ordered) - 1)]
        assert found[p] == (low if low == high or position == int(position) else low + (high - low) * (position - int(position)))
