"""P-values for test statistics, evaluated in Arrow batches over result rows.

Spark has no Student t or normal distribution function. These run on frames
with one row per test, never on trips.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Published response-surface coefficients of the unit-root test
# with a constant, and the statistics between which they apply.
UNIT_ROOT_STAR = -1.61
UNIT_ROOT_MIN = -18.83
UNIT_ROOT_MAX = 2.74
UNIT_ROOT_SMALL = (2.1659, 1.4412, 0.038269)
UNIT_ROOT_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Continued fraction of the incomplete beta function, evaluated bottom up."""
    value = np.ones_like(x)
    for m in range(steps, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = 1 + even / (1 + odd / value)
    first = -(a + b) * x / (a + 1)
    return 1 / (1 + first / value)


def incomplete_beta(a, b, x) -> np.ndarray:
    """Regularised incomplete beta function for arrays."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    log_gamma = np.vectorize(math.lgamma, otypes=[float])
    flip = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    with np.errstate(divide="ignore", invalid="ignore"):
        log_front = log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(y) + q * np.log1p(-y)
        value = np.where(y <= 0, 0.0, np.exp(log_front) / p * _beta_fraction(p, q, y))
    return np.where(flip, 1 - value, value)


def student_p(t, df) -> np.ndarray:
    """Two-sided p-value of Student's t; NaN where t or df is missing."""
    t, df = np.broadcast_arrays(np.asarray(t, dtype=float), np.asarray(df, dtype=float))
    usable = np.isfinite(t) & (df > 0)
    result = np.where(np.isinf(t), 0.0, np.nan)
    result[usable] = incomplete_beta(df[usable] / 2, 0.5, df[usable] / (df[usable] + t[usable] ** 2))
    return result


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def unit_root_p(statistic: float) -> float:
    """P-value of a unit-root statistic for a regression with a constant."""
    if statistic > UNIT_ROOT_MAX:
        return 1.0
    if statistic < UNIT_ROOT_MIN:
        return 0.0
    terms = UNIT_ROOT_SMALL if statistic <= UNIT_ROOT_STAR else UNIT_ROOT_LARGE
    return normal_cdf(sum(c * statistic**power for power, c in enumerate(terms)))


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p-value column for a t statistic and its degrees of freedom."""

    @F.pandas_udf(T.DoubleType())
    def two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
        found = pd.Series(student_p(t, df))
        return found.where(found.notna(), None)

    return two_sided(t.cast("double"), df.cast("double"))
