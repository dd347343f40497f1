"""Data-quality gates as result rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.clean import Rules, flag_valid

# Bounds of the run gates.
MIN_RECORDS = 1_000
MAX_RECORDS = 10_000_000
MIN_SUCCESS_RATE = 0.95
MUST_BE_ZERO = ("null_pickup_count", "null_dropoff_count", "negative_fare_count")


class QualityError(ValueError):
    """A gate failed."""


@dataclass(frozen=True)
class Limits:
    min_records: int = MIN_RECORDS
    max_records: int = MAX_RECORDS
    min_success_rate: float = MIN_SUCCESS_RATE


def count_columns(pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> dict[str, Column]:
    """The counts that the gates look at, as aggregates."""
    return {
        "record_count": F.count(F.lit(1)),
        "null_pickup_count": F.count_if(F.col(pickup).isNull()),
        "null_dropoff_count": F.count_if(F.col(dropoff).isNull()),
        "negative_fare_count": F.count_if(F.col("fare_amount") < 0),
    }


def dq_counts(df: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> DataFrame:
    """One row: records, missing pickups, missing dropoffs, negative fares."""
    return df.agg(*[column.alias(name) for name, column in count_columns(pickup, dropoff).items()])


def failed_gates(counts: Mapping[str, int], limits: Limits) -> list[str]:
    """What a run's observed counts fail, in words; ``rows_read`` and ``record_count`` give the success rate."""
    failed = [f"{name} is {counts[name]}" for name in MUST_BE_ZERO if counts[name]]
    records, read = counts["record_count"], counts["rows_read"]
    if not limits.min_records <= records <= limits.max_records:
        failed.append(f"record_count {records} is not from {limits.min_records} to {limits.max_records}")
    if read and records / read < limits.min_success_rate:
        failed.append(f"success rate {records / read:.4f} is below {limits.min_success_rate}")
    return failed


def _verdicts(counts: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(name).alias("check_name"), value.cast("double").alias("observed"), passed.alias("passed")
        )
        for name, (value, passed) in checks.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def dq_assertions(counts: DataFrame) -> DataFrame:
    """A pass/fail row for every count that has to be zero."""
    return _verdicts(counts, {name: (F.col(name), F.col(name) == 0) for name in MUST_BE_ZERO})


def record_count_bounds(counts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    n = F.col("record_count")
    return _verdicts(
        counts,
        {"min_records": (n, n >= limits.min_records), "max_records": (n, n <= limits.max_records)},
    )


def success_rate(df: DataFrame, rules: Rules, limits: Limits = Limits()) -> DataFrame:
    """Share of input rows passing the cleaning rules, from one pass over the input."""
    rate = F.avg(F.col("is_valid").cast("int"))
    counted = flag_valid(df, rules).agg(
        F.count(F.lit(1)).alias("input_rows"), F.count_if("is_valid").alias("valid_rows"), rate.alias("success_rate")
    )
    return counted.withColumn("passed", F.col("success_rate") >= limits.min_success_rate)


def min_count_check(df: DataFrame, minimum: int = MIN_RECORDS) -> DataFrame:
    return df.agg((F.count(F.lit(1)) >= minimum).alias("passed"))


def require(verdicts: DataFrame) -> None:
    """Raise if any gate row failed. Gates are a handful of rows."""
    failed = [r.asDict() for r in verdicts.where(~F.coalesce(F.col("passed"), F.lit(False))).collect()]
    if failed:
        raise QualityError("; ".join(f"{r.get('check_name', 'gate')}: {r}" for r in failed))


def run_metrics(counts: DataFrame, run_id: str, **labels: str) -> DataFrame:
    """One row of run metrics with its labels and time, ready to append."""
    extra = {name: F.lit(value) for name, value in labels.items()}
    return counts.withColumns({"run_id": F.lit(run_id), **extra, "recorded_at": F.current_timestamp()})


def run_row(spark: SparkSession, metrics: Mapping[str, object]) -> DataFrame:
    """One row of what a run observed of itself (its file, processing and validation metrics), with rate and time."""
    kinds = {int: "bigint", float: "double", str: "string"}
    schema = ", ".join(f"{name} {kinds[type(value)]}" for name, value in metrics.items())
    row = spark.createDataFrame([tuple(metrics.values())], schema)
    rate = F.try_divide(F.col("record_count").cast("double"), F.col("rows_read"))
    return row.withColumns({"success_rate": rate, "recorded_at": F.current_timestamp()})


def append_run_metrics(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)
