"""Repeatable top-k, row limits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n_by(df: DataFrame, measure: str, n: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``measure``; ``ties`` orders equal ones."""
    return df.orderBy(F.desc(measure), *ties).limit(n)


def _shuffled(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("/", F.lit(seed), F.col(key).cast("string")))


def limit_rows(df: DataFrame, n: int, key: str = "trip_id") -> DataFrame:
    """At most ``n`` rows, the same ones on every run."""
    return df.orderBy(_shuffled(key, 0), key).limit(n)


def sample_n(df: DataFrame, n: int = 1000, key: str = "trip_id", seed: int = 42) -> DataFrame:
    """``n`` rows drawn without replacement by a seeded digest of their key."""
    return df.orderBy(_shuffled(key, seed), key).limit(n)
