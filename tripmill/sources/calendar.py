"""Month calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_range(bounds: DataFrame, first: str = "first_month", last: str = "last_month") -> DataFrame:
    """One row per month from ``first`` to ``last`` inclusive, as date, year and month."""
    months = F.explode(F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH")))
    return bounds.select(months.alias("month_start")).select(
        "month_start", F.year("month_start").alias("year"), F.month("month_start").alias("month")
    )
