"""Many reports from one scan: partial aggregates at the finest common key, rolled up per report.

The trips are read once. One aggregation keeps, for every combination of the
reports' keys, the row count and for each measured column its count, sum, least and
greatest value. Each report is then a sum over these cells, which hold one row per
key combination however many trips there are. Results of a bundle can be listed in
long form: part, key, measure, value. Reports with fine keys of different kinds are
rolled up apart, from stored rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.columns import stable_round
from tripmill.operators.reports import Key, Measure, Report
from tripmill.sources.tables import union_tables

#: Text of a null key value in long form.
NULL_KEY = "-"


def _key(key: Key) -> tuple[str, Column]:
    return (key, F.col(key)) if isinstance(key, str) else (key[0], key[1]())


def finest_keys(reports: Mapping[str, Report]) -> dict[str, Column]:
    """All keys of the reports, and the columns that their conditional measures look at."""
    keys = dict(_key(key) for report in reports.values() for key in report.keys)
    asked = [m.where[0] for report in reports.values() for m in report.measures.values() if m.where]
    return keys | {name: F.col(name) for name in asked if name not in keys}


def shared_cells(df: DataFrame, reports: Mapping[str, Report], extra: Sequence[str] = ()) -> DataFrame:
    """The cells of several reports, from one pass over ``df``; ``extra`` columns are measured too."""
    keys = finest_keys(reports)
    measured = [m.column for report in reports.values() for m in report.measures.values() if m.column]
    sums = []
    for name in dict.fromkeys([*measured, *extra]):
        sums.append(F.count(name).alias(f"_count_{name}"))
        if isinstance(df.schema[name].dataType, T.NumericType):
            value = F.col(name)
            sums += [F.sum(value).alias(f"_sum_{name}"), F.min(value).alias(f"_min_{name}"), F.max(value).alias(f"_max_{name}")]
    return df.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(F.count(F.lit(1)).alias("_rows"), *sums)


def _rolled(measure: Measure, digits: int | None) -> Column:
    """A measure as an aggregate of cells."""

    def part(kind: str, missing=None) -> Column:
        value = F.col(f"_{kind}_{measure.column}" if measure.column else "_rows")
        return F.when(F.col(measure.where[0]) == F.lit(measure.where[1]), value).otherwise(missing) if measure.where else value

    if measure.kind == "count":
        return F.coalesce(F.sum(part("count", F.lit(0))), F.lit(0))
    made = {
        "sum": lambda: F.sum(part("sum", F.lit(0.0))),
        "avg": lambda: F.try_divide(F.sum(part("sum")), F.sum(part("count"))),
        "min": lambda: F.min(part("min")),
        "max": lambda: F.max(part("max")),
    }
    if measure.kind not in made:
        raise ValueError(f"{measure.kind} cannot be rolled up from cells")
    value = made[measure.kind]()
    return value if digits is None else stable_round(value, digits)


def roll_up(cells: DataFrame, report: Report) -> DataFrame:
    """The report, from cells instead of rows."""
    result = cells.groupBy(*[_key(key)[0] for key in report.keys]).agg(
        *[_rolled(measure, report.digits).alias(name) for name, measure in report.measures.items()]
    )
    if report.order:
        result = result.orderBy(*[report._term(term) for term in report.order])
    return result if report.top is None else result.limit(report.top)


def bundle(df: DataFrame, reports: Mapping[str, Report], store) -> dict[str, DataFrame]:
    """All reports over one scan; ``store`` keeps the cells (a shared folder) so that the trips are read once."""
    cells = store(shared_cells(df, reports))
    return {name: roll_up(cells, report) for name, report in reports.items()}


def nested(reports: Mapping[str, Report]) -> list[dict[str, Report]]:
    """Reports grouped so that the keys of each are among those of the first of its group, which are as few as can be."""
    keys = {name: set(finest_keys({name: report})) for name, report in reports.items()}
    groups: list[dict[str, Report]] = []
    for name in sorted(keys, key=lambda name: -len(keys[name])):
        wide = [group for group in groups if keys[name] <= keys[next(iter(group))]]
        if wide:
            min(wide, key=lambda group: len(keys[next(iter(group))]))[name] = reports[name]
        else:
            groups.append({name: reports[name]})
    return groups


def bundle_apart(stored: DataFrame, reports: Mapping[str, Report]) -> dict[str, DataFrame]:
    """All reports over stored rows, without their common cells.

    Where the keys of the reports are fine and of different kinds (hours, locations,
    routes), a cell of all of them holds hardly more than one row. Reports are then
    rolled up from the cells of a report that has their keys (:func:`nested`), each
    group from a scan of the columns it needs.
    """
    found = {}
    for group in nested(reports):
        cells = shared_cells(stored, group)
        found |= {name: roll_up(cells, report) for name, report in group.items()}
    return {name: found[name] for name in reports}


def columns_of(reports: Mapping[str, Report]) -> list[str]:
    """The columns that reports with plain keys read."""
    measured = [m.column for report in reports.values() for m in report.measures.values() if m.column]
    return list(dict.fromkeys([*finest_keys(reports), *measured]))


def per_part(report: Report, part: Sequence[str]) -> Report:
    """The report for each value of the ``part`` columns; its order and row limit then hold within a part."""
    return replace(report, keys=(*part, *report.keys), order=(), top=None)


def top_within(result: DataFrame, report: Report, part: Sequence[str]) -> DataFrame:
    """The first ``report.top`` rows of each part in the report's order."""
    if report.top is None:
        return result
    order = Window.partitionBy(*part).orderBy(*[report._term(term) for term in report.order])
    return result.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= report.top).drop("_rank")


def long_form(frames: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None, digits: int = 6) -> DataFrame:
    """Every measure of every frame as a row: part, key, measure, value.

    ``keys`` names the key columns of a part; without an entry these are its
    columns that are not numbers. Text measures join the key behind the others.
    """
    listed = []
    for name, frame in frames.items():
        numeric = [f.name for f in frame.schema if isinstance(f.dataType, T.NumericType)]
        own = list((keys or {}).get(name, [c for c in frame.columns if c not in numeric]))
        own += [c for c in frame.columns if c not in numeric and c not in own]
        text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_KEY)) for c in own])
        values = [F.struct(F.lit(c).alias("measure"), stable_round(F.col(f"`{c}`").cast("double"), digits).alias("value")) for c in numeric if c not in own]
        listed.append(frame.select(F.lit(name).alias("part"), text.alias("key"), F.inline(F.array(*values))))
    return union_tables(listed)
