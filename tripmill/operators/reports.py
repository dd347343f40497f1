"""Grouped reports described as data: keys, measures, order and row limit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.columns import label_rank, stable_round


@dataclass(frozen=True)
class Measure:
    """An aggregate; ``where`` restricts it to rows with that column value."""

    kind: str
    column: str | None = None
    where: tuple[str, object] | None = None

    def build(self, digits: int | None) -> Column:
        if self.kind == "count" and self.where:
            return F.count_if(F.col(self.where[0]) == F.lit(self.where[1]))
        if self.kind == "count":
            return F.count(F.lit(1) if self.column is None else F.col(self.column))
        value = F.col(self.column)
        if self.where:
            value = F.when(F.col(self.where[0]) == F.lit(self.where[1]), value).otherwise(F.lit(0.0))
        made = {"avg": F.avg, "sum": F.sum, "std": F.stddev_samp, "min": F.min, "max": F.max}[self.kind](value)
        return made if digits is None else stable_round(made, digits)


COUNT = Measure("count")


def avg(column: str) -> Measure:
    return Measure("avg", column)


def total(column: str, where: tuple[str, object] | None = None) -> Measure:
    return Measure("sum", column, where)


def std(column: str) -> Measure:
    return Measure("std", column)


def count_where(column: str, value: object) -> Measure:
    return Measure("count", None, (column, value))


def count_of(column: str) -> Measure:
    return Measure("count", column)


Key = str | tuple[str, Callable[[], Column]]


@dataclass(frozen=True)
class Report:
    """``order`` terms: a column, ``-column`` for descending, or (column, labels).

    All aggregates combine partially before the shuffle, so a key holding most
    rows sends one row per task like any other.
    """

    keys: tuple[Key, ...]
    measures: dict[str, Measure] = field(hash=False)
    order: tuple[str | tuple[str, tuple[str, ...]], ...] = ()
    digits: int | None = None
    top: int | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        keys = [F.col(k) if isinstance(k, str) else k[1]().alias(k[0]) for k in self.keys]
        result = df.groupBy(*keys).agg(
            *[measure.build(self.digits).alias(name) for name, measure in self.measures.items()]
        )
        if self.order:
            result = result.orderBy(*[self._term(term) for term in self.order])
        return result if self.top is None else result.limit(self.top)

    @staticmethod
    def _term(term: str | tuple[str, tuple[str, ...]]) -> Column:
        if isinstance(term, tuple):
            return label_rank(*term).asc_nulls_last()
        return F.desc(term[1:]) if term.startswith("-") else F.asc(term)
