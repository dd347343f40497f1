"""Small column builders shared by the feature layer and the reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def stable_round(value: ColumnOrName, digits: int) -> Column:
    """Round an aggregate half up, whatever order its rows were added in.

    The last bits of a distributed sum vary from run to run; dropping them
    first keeps a value at a rounding boundary on the same side.
    """
    return F.round(F.round(as_column(value), 9), digits)


def bin_cut(value: ColumnOrName, bands: Iterable[tuple[float, str]], floor: float | None = None) -> Column:
    """Right-closed bins: the first band whose upper edge is not below ``value``.

    Null input gives null. With ``floor`` set, values at or below it give null;
    so do values above the last edge.
    """
    value = as_column(value)
    inside = F.lit(True) if floor is None else value > floor
    label = None
    for edge, text in bands:
        fits = value.isNotNull() if edge == float("inf") else value <= edge
        condition = fits & inside
        label = F.when(condition, text) if label is None else label.when(condition, text)
    return label


def label_rank(value: ColumnOrName, labels: Iterable[str]) -> Column:
    """Position of a label in its display order, null for labels outside it."""
    pairs = [F.lit(x) for rank, label in enumerate(labels, 1) for x in (label, rank)]
    return F.try_element_at(F.create_map(*pairs), as_column(value))


def lookup(value: ColumnOrName, labels: Mapping[int, str], missing: str) -> Column:
    """Label of a code; ``missing`` for other codes and for null.

    A chain of tests compiles to far less code than a map lookup, which keeps
    the projection below the size the JVM still compiles.
    """
    value = as_column(value)
    chain = F
    for code, label in labels.items():
        chain = chain.when(value == code, label)
    return chain.otherwise(missing)


def ratio(over: ColumnOrName, under: ColumnOrName, rule: str = "null", scale: float = 1) -> Column:
    """``over / under * scale`` that never raises.

    rule ``"null"``: null for a zero divisor; ``"positive"``: null unless the
    divisor is positive; ``"zero"``: 0 unless the divisor is positive.
    """
    over, under = as_column(over), as_column(under)
    value = F.try_divide(over, under)
    if scale != 1:
        value = value * F.lit(scale)
    if rule == "null":
        return value
    guarded = F.when(under > 0, value)
    return guarded.otherwise(F.lit(0.0)) if rule == "zero" else guarded


def minutes_between(start: ColumnOrName, end: ColumnOrName, whole_seconds: bool = True) -> Column:
    start, end = as_column(start), as_column(end)
    if whole_seconds:
        return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000)


def on_weekend(when: ColumnOrName) -> Column:
    """True on Saturday and Sunday (Spark numbers Sunday 1 and Saturday 7)."""
    return F.dayofweek(as_column(when)).isin(1, 7)


def day_type(flag: ColumnOrName) -> Column:
    return F.when(as_column(flag).cast("boolean"), "Weekend").otherwise("Weekday")


def demand_level(value: ColumnOrName, mean: Column, spread: Column) -> Column:
    value = as_column(value)
    return (
        F.when(value > mean + spread, "High").when(value < mean - spread, "Low").otherwise("Normal")
    )


def month_start(year: ColumnOrName, month: ColumnOrName) -> Column:
    return F.make_date(as_column(year), as_column(month), F.lit(1))


def landing_path(year: ColumnOrName, month: ColumnOrName, prefix: str = "yellow_tripdata") -> Column:
    """``raw/{year}/{month}/{prefix}_{year}-{month}.parquet`` as a column."""
    year, month = as_column(year).cast("int"), as_column(month).cast("int")
    return F.format_string(f"raw/%d/%02d/{prefix}_%d-%02d.parquet", year, month, year, month)


def dated_file_name(name: ColumnOrName, when: ColumnOrName) -> Column:
    """File name with a ``_yyyyMMdd`` suffix before its extension."""
    stamp = F.date_format(as_column(when), "yyyyMMdd")
    return F.regexp_replace(as_column(name), F.lit(r"(\.[^./]+)$"), F.concat(F.lit("_"), stamp, F.lit("$1")))
