"""Distribution statistics, correlations, tests and chart datasets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.pvalues import t_pvalue
from tripmill.operators.outliers import with_fences
from tripmill.operators.quantiles import linked, long_form, quantiles, spread
from tripmill.session import settle

# Columns of the standard statistics.
CORE_METRICS = ("total_amount", "trip_distance", "trip_duration_minutes", "tip_percentage", "speed_mph")
RANGE_COLUMNS = ("trip_distance", "total_amount", "trip_duration_minutes")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def corrected_skew(value: str) -> Column:
    """Bias-corrected skewness; null below three values or without spread."""
    n = F.count(value)
    g1 = F.skewness(value)
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(value: str) -> Column:
    """Bias-corrected excess kurtosis; null below four values or without spread."""
    n = F.count(value)
    g2 = F.kurtosis(value)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """One aggregate over all columns, returned as one row per column."""
    wide = df.agg(*[make(name).alias(f"{name}|{label}") for name in columns for label, make in measures.items()])
    rows = [
        F.struct(F.lit(name).alias("metric"), *[F.col(f"`{name}|{label}`").alias(label) for label in measures])
        for name in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def _stored(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns stored once, as several passes read them."""
    return settle(df.select(*dict.fromkeys(columns)), "numbers")


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False, stored: bool = False, quartiles: DataFrame | None = None
) -> DataFrame:
    """Count, mean, std, min, quartiles and max per numeric column.

    The columns are stored first, as several passes read them, unless ``stored``
    states that ``df`` reads stored rows. ``quartiles`` are its quantiles if known.
    """
    columns = list(columns or numeric_columns(df))
    df = df if stored or approx else _stored(df, columns)
    moments = _per_column(
        df,
        columns,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(F.col(c).cast("double")),
            "max": lambda c: F.max(F.col(c).cast("double")),
        },
    )
    found = quantiles(df, columns, [0.25, 0.5, 0.75], approx=approx, stored=True) if quartiles is None else quartiles
    joined = moments.join(F.broadcast(spread(found, {0.25: "q25", 0.5: "q50", 0.75: "q75"})), "metric", "left")
    return joined.select("metric", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def _moment_table(df: DataFrame, columns: Sequence[str], measures: dict, approx: bool, stored: bool, quartiles: DataFrame | None = None) -> DataFrame:
    df = df if stored or approx else _stored(df, columns)
    moments = _per_column(df, columns, measures)
    found = quantiles(df, columns, [0.5], approx=approx, stored=True) if quartiles is None else quartiles
    medians = spread(found, {0.5: "median"})
    return moments.join(F.broadcast(medians), "metric", "left")


def basic_stats(df: DataFrame, columns: Sequence[str] = CORE_METRICS, approx: bool = False, stored: bool = False) -> DataFrame:
    """Mean, median, std, skew and kurtosis per column; ``stored`` as in :func:`describe_numeric`."""
    measures = {"mean": F.avg, "std": F.stddev_samp, "skew": corrected_skew, "kurtosis": corrected_kurtosis}
    return _moment_table(df, list(columns), measures, approx, stored)


def distribution_stats(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False, stored: bool = False, quartiles: DataFrame | None = None
) -> DataFrame:
    """Mean, median, std and skew for every numeric column; ``stored`` and ``quartiles`` as in :func:`describe_numeric`."""
    measures = {"mean": F.avg, "std": F.stddev_samp, "skew": corrected_skew}
    return _moment_table(df, list(columns or numeric_columns(df)), measures, approx, stored, quartiles)


_MASK_BITS = 62


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORE_METRICS) -> DataFrame:
    """Pearson matrix as rows (metric_a, metric_b, r).

    Rows with a null in either column are left out of that pair only. A column
    without spread correlates with nothing, itself included: null.

    Rows are summed per pattern of missing columns, one product per pair, so
    the pairwise treatment of nulls costs nothing per row. Values are taken
    relative to the column minimum, which makes a constant column exactly zero.
    """
    columns = list(columns)
    size = range(len(columns))
    pairs = [(i, j) for i in size for j in size if i <= j]
    masks = range(0, len(columns), _MASK_BITS)
    least = df.agg(F.struct(*[F.min(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)])).scalar()
    # Expression text below: a few hundred columns are built in one call each.
    shifted = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)], least.alias("low"))
    missing = [
        " | ".join(f"IF(v{i} IS NULL, {1 << (i - start)}L, 0L)" for i in size[start : start + _MASK_BITS])
        for start in masks
    ]
    patterns = (
        shifted.selectExpr(
            *[f"v{i} - low.m{i} AS x{i}" for i in size], *[f"{text} AS mask{k}" for k, text in enumerate(missing)]
        )
        .groupBy(*[f"mask{k}" for k in range(len(missing))])
        .agg(
            F.expr("count(*) AS n"),
            F.expr(f"array({', '.join(f'sum(x{i})' for i in size)}) AS s"),
            F.expr(f"array({', '.join(f'min(x{i})' for i in size)}) AS lo"),
            F.expr(f"array({', '.join(f'max(x{i})' for i in size)}) AS hi"),
            F.expr(f"array({', '.join(f'sum(x{i} * x{j})' for i, j in pairs)}) AS p"),
        )
    )
    numbers = {
        "i": [i for i, _ in pairs],
        "j": [j for _, j in pairs],
        "diagonal": [k for k, (i, j) in enumerate(pairs) if i == j],
    }
    first, second, diagonal = (f"array({', '.join(map(str, numbers[key]))})" for key in ("i", "j", "diagonal"))
    mask_list = f"array({', '.join(f'mask{k}' for k in range(len(missing)))})"

    def present(index: str) -> str:
        return f"shiftright({mask_list}[{index} DIV {_MASK_BITS}], CAST({index} % {_MASK_BITS} AS int)) & 1L = 0"

    summed = (
        patterns.selectExpr("*", "posexplode(p) AS (k, ab)")
        .selectExpr("*", f"{first}[k] AS i", f"{second}[k] AS j")
        .where(f"{present('i')} AND {present('j')}")
        .selectExpr(
            "i", "j", "n", "s[i] AS a", "s[j] AS b", f"p[{diagonal}[i]] AS aa", f"p[{diagonal}[j]] AS bb", "ab",
            "lo[i] AS a_lo", "hi[i] AS a_hi", "lo[j] AS b_lo", "hi[j] AS b_hi",
        )
        .groupBy("i", "j")
        .agg(
            *[F.sum(name).alias(name) for name in ("n", "a", "b", "aa", "bb", "ab")],
            (F.max("a_hi") > F.min("a_lo")).alias("a_varies"),
            (F.max("b_hi") > F.min("b_lo")).alias("b_varies"),
        )
    )
    n, a, b = F.col("n"), F.col("a"), F.col("b")

    def varied(squares: Column, total: Column, varies: str) -> Column:
        return F.when(F.col(varies), F.greatest(squares - total * total / n, F.lit(0.0)))

    root = F.sqrt(varied(F.col("aa"), a, "a_varies")) * F.sqrt(varied(F.col("bb"), b, "b_varies"))
    r = F.when(F.col("i") == F.col("j"), F.when(root.isNotNull(), F.lit(1.0))).otherwise(
        F.try_divide(F.col("ab") - a * b / n, root)
    )
    cells = df.sparkSession.range(len(columns)).selectExpr("CAST(id AS int) AS row").selectExpr(
        "row", f"explode(sequence(0, {len(columns) - 1})) AS column"
    )
    placed = cells.selectExpr("row", "column", "least(row, column) AS i", "greatest(row, column) AS j")
    label = F.array(*[F.lit(c) for c in columns])
    return placed.join(F.broadcast(summed.select("i", "j", r.alias("r"))), ["i", "j"], "left").select(
        F.element_at(label, F.col("row") + 1).alias("metric_a"),
        F.element_at(label, F.col("column") + 1).alias("metric_b"),
        "r",
    )


def correlation_all_numeric(df: DataFrame) -> DataFrame:
    return correlation_matrix(df, numeric_columns(df))


def two_sample_ttest(
    df: DataFrame, flag: str = "is_weekend", value: str = "total_amount", by: Sequence[str] = ()
) -> DataFrame:
    """Pooled-variance t-test of ``value`` where ``flag`` is false against where it is true.

    One aggregate per row set; with ``by``, one test per group.
    """
    def side(state: bool) -> Column:
        return F.when(F.col(flag).cast("boolean") == F.lit(state), F.col(value))

    sums = df.groupBy(*by).agg(
        *[
            make(side(state)).alias(f"{label}_{name}")
            for name, state in (("weekday", False), ("weekend", True))
            for label, make in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
        ]
    )
    n1, n2 = F.col("n_weekday"), F.col("n_weekend")
    pooled = F.try_divide(
        (n1 - 1) * F.col("var_weekday") + (n2 - 1) * F.col("var_weekend"), (n1 + n2 - 2).cast("double")
    )
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return sums.select(
        *by,
        "n_weekday",
        "n_weekend",
        "mean_weekday",
        "mean_weekend",
        F.try_divide(F.col("mean_weekday") - F.col("mean_weekend"), error).alias("t_statistic"),
        (n1 + n2 - 2).alias("degrees"),
    )


def weekend_ttest(
    df: DataFrame, flag: str = "is_weekend", value: str = "total_amount", by: Sequence[str] = ()
) -> DataFrame:
    """The two-sample test with its two-sided p-value."""
    tested = two_sample_ttest(df, flag, value, by)
    return tested.withColumn("p_value", t_pvalue(F.col("t_statistic"), F.col("degrees")))


def five_number_summary(
    df: DataFrame, value: str, by: Sequence[str], approx: bool = False, few_groups: bool = False
) -> DataFrame:
    """Box-plot data per group: quartiles, whiskers, extremes and outlier count.

    Whiskers are the furthest values still inside 1.5 interquartile ranges.
    """
    by = list(by)
    found = quantiles(df, [value], [0.25, 0.5, 0.75], by, approx, few_groups)
    boxes, same_group = linked(with_fences(spread(found, {0.25: "q1", 0.5: "median", 0.75: "q3"}, by)), by)
    boxes = boxes.drop("metric")
    boxes = F.broadcast(boxes) if few_groups else settle(boxes, "boxes")
    rows = long_form(df, [value], by)
    inside = F.col("value").between(F.col("lower_bound"), F.col("upper_bound"))
    boxed = (
        rows.join(boxes, same_group)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("value").alias("minimum"),
            F.max("value").alias("maximum"),
            F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return boxed.select(
        *by, "n", "minimum", "lower_whisker", "q1", "median", "q3", "upper_whisker", "maximum", "outliers"
    )


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bin; the maximum falls into the last one."""
    share = F.try_divide(F.lit(bins) * (value - low), high - low)
    return F.least(F.coalesce(F.floor(share), F.lit(0)).cast("int") + 1, F.lit(bins))


def histogram_bins(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of a column; empty bins have count 0."""
    value = F.col(column).cast("double")
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("bounds"))
    limits = bounds.scalar()
    low, high = limits.getField("low"), limits.getField("high")
    counted = (
        df.where(value.isNotNull())
        .groupBy(_bin(value, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    edges = df.sparkSession.range(1, bins + 1).select(
        F.col("id").cast("int").alias("bin"), low.alias("_low"), ((high - low) / bins).alias("_width")
    )
    return edges.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (F.col("_low") + (F.col("bin") - 1) * F.col("_width")).alias("bin_start"),
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_end"),
        F.coalesce("_n", F.lit(0)).alias("row_count"),
    )


def auto_histogram(df: DataFrame, columns: Sequence[str] | None = None, stored: bool = False) -> DataFrame:
    """Histograms of several columns with bins fitted to each; bins without rows are left out.

    The bin width is the smaller of the Freedman-Diaconis width, from exact
    quartiles, and the Sturges width; a column without spread has one bin. Each
    column is counted by a scan of its own, which combines counts before the shuffle;
    no row is expanded. The density is the share of rows over the bin's width, null
    without spread. Columns without values are absent. ``stored`` as in
    :func:`describe_numeric`.
    """
    columns = list(columns or numeric_columns(df))
    df = df if stored else _stored(df, columns)
    shape = describe_numeric(df, columns, stored=True).where(F.col("count") > 0)
    n, span = F.col("count").cast("double"), F.col("max") - F.col("min")
    wide, close = 2 * (F.col("q75") - F.col("q25")) / F.pow(n, F.lit(1 / 3)), span / (F.log2(n) + 1)
    width = F.when(wide > 0, F.least(wide, close)).otherwise(close)
    shape = shape.select("metric", "count", F.col("min").alias("_low"), span.alias("_span"), F.when(span > 0, F.ceil(span / width)).otherwise(1).cast("int").alias("bins"))
    found = {r["metric"]: r for r in shape.collect()}  # a row per column
    binned = []
    for name, r in found.items():
        value = F.col(name).cast("double")
        place = F.floor((value - F.lit(r["_low"])) * F.lit(float(r["bins"])) / F.lit(r["_span"])) if r["_span"] > 0 else F.lit(0)
        kept = df.where(value.isNotNull() & ~F.isnan(value)).groupBy(F.least(place, F.lit(r["bins"] - 1)).cast("int").alias("bin"))
        binned.append(kept.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("metric"), "bin", "row_count"))
    counted = reduce(DataFrame.unionByName, binned) if binned else df.sparkSession.createDataFrame([], "metric string, bin int, row_count bigint")
    known = df.sparkSession.createDataFrame([tuple(r) for r in found.values()], shape.schema)
    step = F.col("_span") / F.col("bins")
    return counted.join(F.broadcast(known), "metric").select(
        "metric", (F.col("bin") + 1).alias("bin"), (F.col("_low") + F.col("bin") * step).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * step).alias("bin_end"), "row_count",
        F.try_divide(F.col("row_count"), F.col("count") * step).alias("density"),
    )


def density(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    bins: int = 128,
    points: int = 64,
    few_groups: bool = False,
) -> DataFrame:
    """Gaussian kernel density per group on an even grid from minimum to maximum.

    Values are first counted in ``bins`` equal bins per group, so the kernel
    sums run over a fixed number of bins whatever the row count. Bandwidth is
    Scott's rule; groups without spread give no rows.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    shape = rows.groupBy(*by).agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count(F.lit(1)).alias("_n"),
        F.stddev_samp("_v").alias("_std"),
    ).where(F.col("_high") > F.col("_low"))
    shape, same_group = linked(shape, by)
    shape = F.broadcast(shape) if few_groups else settle(shape, "shape")
    shape_columns = ["_low", "_high", "_n", "_std"]
    counted = (
        rows.join(shape, same_group)
        .groupBy(*by, *shape_columns, _bin(F.col("_v"), F.col("_low"), F.col("_high"), bins).alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    span = F.col("_high") - F.col("_low")
    centre = F.col("_low") + (F.col("_bin") - 0.5) * span / bins
    binned = counted.groupBy(*by, *shape_columns).agg(
        F.sort_array(F.collect_list(F.struct(centre.alias("c"), F.col("_c").alias("n")))).alias("_bins")
    )
    width = F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    x = F.col("_low") + F.col("_i") * span / (points - 1)
    kernel = F.aggregate(
        "_bins",
        F.lit(0.0),
        lambda total, b: total + b["n"] * F.exp(-0.5 * F.pow((F.col("x") - b["c"]) / F.col("_h"), F.lit(2))),
    )
    norm = F.col("_n") * F.col("_h") * F.lit((2 * 3.141592653589793) ** 0.5)
    gridded = binned.withColumns({"_h": width, "_i": grid}).withColumn("x", x)
    return gridded.select(*by, F.col("_i").alias("point"), "x", (kernel / norm).alias("density"))


def ols_trend_line(
    df: DataFrame, x: str = "trip_distance", y: str = "trip_duration_minutes", by: str = "time_of_day"
) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group."""
    return df.groupBy(by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r_squared"),
        F.regr_count(y, x).alias("points"),
    )


def zscore_profile(profile: DataFrame, key: str = "time_of_day") -> DataFrame:
    """Columns of an aggregated frame standardised over its rows (population std).

    The window is unpartitioned: the input holds one row per label.
    """
    everything = Window.partitionBy(F.lit(0))
    scaled = []
    for name in profile.columns:
        if name != key:
            value = F.col(name)
            spread_ = F.stddev_pop(value).over(everything)
            centred = value - F.avg(value).over(everything)
            scaled.append(F.when(spread_ == 0, F.lit(0.0)).otherwise(F.try_divide(centred, spread_)).alias(name))
    return profile.select(key, *scaled)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, in one pass."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in df.columns]
    return wide.select(F.inline(F.array(*rows)))


def value_ranges(df: DataFrame, columns: Sequence[str] = RANGE_COLUMNS) -> DataFrame:
    return _per_column(df, list(columns), {"min_value": F.min, "max_value": F.max})
