"""Table sources: named tables, month slices, unions of tables and SQL text."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schemas import RAW_TO_ANALYTICS


def scan_table(spark: SparkSession, name: str, source: str | None = None, **options: str) -> DataFrame:
    """A catalogue table, or any connector when ``source`` names its format."""
    if source is None:
        return spark.table(name)
    return spark.read.format(source).options(**options).load(name)


def month_slice(df: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one pickup month, by the (partition) columns of the table."""
    return df.where((F.col("pickup_year") == year) & (F.col("pickup_month") == month))


def month_span(df: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Rows of the months from ``first`` to ``last`` inclusive, prunable by partition."""
    number = F.col("pickup_year") * 12 + F.col("pickup_month")
    years = F.col("pickup_year").between(first[0], last[0])
    return df.where(years & number.between(first[0] * 12 + first[1], last[0] * 12 + last[1]))


def union_tables(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; columns a frame lacks are null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def to_analytics_names(df: DataFrame) -> DataFrame:
    """Raw-style names to analytics style; the payment code becomes text."""
    renamed = df.withColumnsRenamed(RAW_TO_ANALYTICS)
    return renamed.withColumn("payment_type", F.col("payment_type").cast("string"))


def run_query(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text with bound parameters (``:name``) and frames (``{name}``)."""
    return spark.sql(text, args=args or {}, **frames)
