"""Exact percentiles that never gather a whole group in one task.

Over a whole table, every wanted rank is narrowed to an interval of values by a few
passes over the wanted columns alone, which are stored first so that what they are
made from is done once. A pass counts, column by column, the rows between the ends of
all its intervals, and takes a mergeable sketch of the few rows within one. Rows are
neither expanded nor shuffled. Once an interval holds few values, the pass returns
these themselves.

Within groups, a sketch first brackets every rank per group. Only values inside
the narrow bracket are then counted one by one; everything else is merely counted
per side. Inside the bracket, ranks are located by bucket before single values
are ordered, so no task orders more than a sliver of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.session import settle

ACCURACY = 10_000
SLACK = 3 / ACCURACY
BUCKETS = 1024
#: Evenly spaced ranks that a narrowing pass asks its sketch for, and values that the last pass returns at most.
CUTS = 1024
LAST_VALUES = 10_000


def long_form(df: DataFrame, columns: Sequence[str], keep: Iterable[str] = ()) -> DataFrame:
    """Rows (keep..., metric, value) for each non-null value of the columns."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")) for name in columns
    ]
    if len(pairs) == 1:
        rows = df.select(*keep, F.lit(columns[0]).alias("metric"), F.col(columns[0]).cast("double").alias("value"))
    else:
        rows = df.select(*keep, F.inline(F.array(*pairs)))
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value"))


def linked(lookup: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``lookup`` with its keys renamed and the null-safe condition joining it on them."""
    renamed = lookup.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return renamed, condition


def _bracketed(rows: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Per key and wanted percentile: row count and a value range holding its rank."""
    low = [max(0.0, p - SLACK) for p in probs]
    high = [min(1.0, p + SLACK) for p in probs]
    sketch = rows.groupBy(*keys).agg(
        F.percentile_approx("value", low + high, ACCURACY).alias("_cuts"),
        F.min("value").alias("_min"),
        F.max("value").alias("_max"),
        F.count(F.lit(1)).alias("_n"),
    )
    # Few rows make the slack narrower than one rank: take the whole range then.
    few = F.col("_n") <= ACCURACY
    wanted = [
        F.struct(
            F.lit(float(p)).alias("p"),
            F.when(few, F.col("_min")).otherwise(F.col("_cuts")[i]).alias("_lo"),
            F.when(few, F.col("_max")).otherwise(F.col("_cuts")[i + len(probs)]).alias("_hi"),
        )
        for i, p in enumerate(probs)
    ]
    return sketch.select(*keys, "_n", F.inline(F.array(*wanted)))


def _holds(rank: Column, start: Column, size: Column) -> Column:
    return (start <= rank) & (rank < start + size)


@dataclass
class _Search:
    """The interval that holds the wanted ranks of one column: its ends, and the rows below it and within it."""

    column: str
    number: str
    ranks: set[int]
    low: float
    high: float
    below: int
    within: int
    cuts: list[float] | None
    reach: int = 1
    before: tuple | None = None
    found: dict[int, float] = field(default_factory=dict)

    @property
    def open(self) -> list[int]:
        return sorted(self.ranks - set(self.found))

    def narrow(self) -> None:
        """The cuts around the open ranks as the new ends, one spacing beyond what the sketch is unsure of."""
        first, last = self.open[0] - self.below, self.open[-1] - self.below
        left, right = (int(rank / max(1, self.within) * CUTS) for rank in (first, last))
        self.before = (self.low, self.high, self.below, self.within, self.cuts)
        at = lambda i: self.cuts[min(max(i, 0), CUTS)]
        self.low, self.high = at(left - self.reach), at(right + 1 + self.reach)

    @property
    def few(self) -> bool:
        """Whether the next pass is sure to find few values within the interval."""
        if self.within <= LAST_VALUES:
            return True
        spread = (self.open[-1] - self.open[0]) / self.within + (2 * self.reach + 2) / CUTS + 4 / ACCURACY
        return self.within * spread <= LAST_VALUES

    def counts(self, name: str) -> list[Column]:
        """Rows below the interval, up to its lower end, and up to its upper end."""
        value, low, high = F.col(self.number), F.lit(self.low), F.lit(self.high)
        conditions = {"below": value < low, "low": value <= low, "high": value <= high}
        return [F.count_if(condition).alias(f"{name}_{kind}") for kind, condition in conditions.items()]

    @property
    def inside(self) -> Column:
        return (F.col(self.number) > F.lit(self.low)) & (F.col(self.number) < F.lit(self.high))

    def rest(self, name: str, spaced: Column) -> list[Column]:
        """The number of values within the interval, and these themselves if they are few, else cuts of them."""
        kept = F.when(self.inside, F.col(self.number))
        found = F.collect_list(kept) if self.few else F.percentile_approx(kept, spaced, ACCURACY)
        return [F.count(kept).alias(f"{name}_inside"), found.alias(f"{name}_rest")]

    def learn(self, row: dict, name: str) -> None:
        below, low, high, inside = (row[f"{name}_{kind}"] for kind in ("below", "low", "high", "inside"))
        few = self.few
        rest = sorted(row[f"{name}_rest"]) if few else row[f"{name}_rest"]
        if self.open[0] < below or self.open[-1] >= high:
            # the sketch was further off than it may be: a wider interval of the pass before
            _, _, self.below, self.within, self.cuts = self.before
            self.reach *= 4
            self.narrow()
            return
        for rank in self.open:
            if rank < low:
                self.found[rank] = self.low
            elif rank >= low + inside:
                self.found[rank] = self.high
            elif few:
                self.found[rank] = rest[rank - low]
        self.below, self.within, self.cuts, self.reach = low, inside, None if few else rest, 1
        if self.open:
            self.narrow()


def _number(df: DataFrame, column: str) -> Column:
    """The column as a double; NaN counts as missing."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value) if isinstance(df.schema[column].dataType, T.FractionalType) else value


def _spaced() -> Column:
    """Evenly spaced ranks, as one constant."""
    return F.expr(f"array({', '.join(f'{i / CUTS!r}D' for i in range(CUTS + 1))})")


def _rows_of(searched: DataFrame, names: Iterable[str], kinds: Sequence[str]) -> DataFrame:
    """The measures of several searches, which are columns of one row, as a row for each."""
    rows = [F.struct(F.lit(name).alias("search"), *[F.col(f"{name}_{kind}").alias(kind) for kind in kinds]) for name in names]
    return searched.select(F.inline(F.array(*rows)))


def _narrowing_pass(numbers: DataFrame, pending: Sequence[_Search], spaced: Column) -> None:
    """Count the rows up to the ends of the intervals, and look into these; each column is aggregated by a scan of its own, small enough to be compiled."""
    of_column: dict[str, dict[str, _Search]] = {}
    for i, search in enumerate(pending):
        of_column.setdefault(search.number, {})[f"s{i}"] = search
    counted, looked = [], []
    for number, own in of_column.items():
        values = numbers.select(number)
        within = values.where(reduce(Column.__or__, [search.inside for search in own.values()]))
        counted.append(_rows_of(values.agg(*[m for name, search in own.items() for m in search.counts(name)]), own, ("below", "low", "high")))
        looked.append(_rows_of(within.agg(*[m for name, search in own.items() for m in search.rest(name, spaced)]), own, ("inside", "rest")))
    found: dict[str, dict] = {f"s{i}": {} for i in range(len(pending))}
    for frames in (counted, looked):
        for row in reduce(DataFrame.unionByName, frames).collect():  # a row per search
            found[row["search"]] |= {f"{row['search']}_{kind}": value for kind, value in row.asDict().items()}
    for i, search in enumerate(pending):
        search.learn(found[f"s{i}"], f"s{i}")


def _table_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], stored: bool) -> list[tuple[str, float, float]]:
    """(metric, p, value) of a whole table; the driver receives counts, cuts and at most ``LAST_VALUES`` values for each rank."""
    columns = list(dict.fromkeys(columns))
    numbers = df.select(*[_number(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    if not stored:
        numbers = settle(numbers, "numbers")
    spaced = _spaced()
    measures = {"n": F.count, "cuts": lambda v: F.percentile_approx(v, spaced, ACCURACY)}
    first = numbers.agg(*[make(f"v{i}").alias(f"{i}_{kind}") for i in range(len(columns)) for kind, make in measures.items()]).first()
    searches: list[tuple[float, _Search, int]] = []
    for i, column in enumerate(columns):
        n, cuts = first[f"{i}_n"], first[f"{i}_cuts"]
        for p in probs if n else ():
            rank = math.floor((n - 1) * p)
            search = _Search(column, f"v{i}", {rank, min(rank + 1, n - 1)}, 0.0, 0.0, 0, n, cuts)
            search.narrow()
            searches.append((float(p), search, n))
    while pending := [search for _, search, _ in searches if search.open]:
        _narrowing_pass(numbers, pending, spaced)
    found = []
    for p, search, n in searches:
        position = (n - 1) * p
        rank = math.floor(position)
        low, high = search.found[rank], search.found[min(rank + 1, n - 1)]
        exact = position == rank or low == high  # infinite ends have no distance
        found.append((search.column, p, low if exact else low + (high - low) * (position - rank)))
    return found


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    few_groups: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Rows (by..., metric, p, value), linearly interpolated as ``percentile`` does.

    Without ``by`` the passes run when this is called, and the result holds one row
    per column and percentile; the columns are stored first unless ``stored`` states
    that ``df`` reads stored rows. With ``by`` the bracket table is broadcast only if
    ``few_groups`` states that the group labels come from a fixed list. Otherwise it
    is stored first, so the engine picks the join from its real size: small ones are
    broadcast and the rows are not shuffled.
    """
    by = list(by)
    if not by:
        return df.sparkSession.createDataFrame(_table_quantiles(df, columns, probs, stored), "metric string, p double, value double")
    keys = [*by, "metric"]
    rows = long_form(df, columns, by)
    brackets, condition = linked(_bracketed(rows, keys, probs), keys)
    brackets = F.broadcast(brackets) if few_groups else settle(brackets, "brackets")
    side = F.when(F.col("value") < F.col("_lo"), -1).when(F.col("value") > F.col("_hi"), BUCKETS).otherwise(0)
    target = [*keys, "p", "_n", "_lo", "_hi"]
    points = (
        rows.join(brackets, condition)
        .select(*keys, "p", "_n", "_lo", "_hi", side.alias("_side"), "value")
        .groupBy(*target, "_side", F.when(F.col("_side") == 0, F.col("value")).alias("_point"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    share = F.try_divide(F.col("_point") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * (BUCKETS - 1)
    inner = F.coalesce(F.floor(F.nanvl(share, F.lit(0.0))).cast("int"), F.lit(0))
    points = points.withColumn("_bucket", F.when(F.col("_side") == 0, inner).otherwise(F.col("_side")))

    position = (F.col("_n") - 1) * F.col("p")
    first = F.floor(position)
    second = F.least(first + 1, F.col("_n") - 1)
    target_window = Window.partitionBy(*target).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (
        points.groupBy(*target, "_bucket")
        .agg(F.sum("_c").alias("_size"))
        .withColumn("_start", F.sum("_size").over(target_window) - F.col("_size"))
        .where(
            _holds(first, F.col("_start"), F.col("_size")) | _holds(second, F.col("_start"), F.col("_size"))
        )
        .select(*keys, "p", "_bucket", "_start")
    )
    link = [*keys, "p", "_bucket"]
    chosen, at = linked(chosen, link)
    if few_groups:
        chosen = F.broadcast(chosen)
    within = Window.partitionBy(*link).orderBy("_point").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        points.join(chosen, at)
        .select(*link, "_n", "_point", "_c", "_start")
        .withColumn("_from", F.col("_start") + F.sum("_c").over(within) - F.col("_c"))
    )
    picked = ranked.groupBy(*keys, "p", "_n").agg(
        F.max(F.when(_holds(first, F.col("_from"), F.col("_c")), F.col("_point"))).alias("_a"),
        F.max(F.when(_holds(second, F.col("_from"), F.col("_c")), F.col("_point"))).alias("_b"),
    )
    outside = F.col("_a").isNull() | F.col("_b").isNull()
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * (position - first)
    return picked.select(
        *keys,
        "p",
        F.when(outside, F.raise_error(F.lit("percentile rank outside its bracket"))).otherwise(value).alias("value"),
    )


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """Same shape as :func:`exact_quantiles` from one sketch pass."""
    keys = [*by, "metric"]
    sketch = long_form(df, columns, by).groupBy(*keys).agg(
        F.percentile_approx("value", list(probs), accuracy).alias("_cuts")
    )
    pairs = [
        F.struct(F.lit(float(p)).alias("p"), F.col("_cuts")[i].alias("value")) for i, p in enumerate(probs)
    ]
    return sketch.select(*keys, F.inline(F.array(*pairs)))


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
    few_groups: bool = False,
    stored: bool = False,
) -> DataFrame:
    if approx:
        return approx_quantiles(df, columns, probs, by)
    return exact_quantiles(df, columns, probs, by, few_groups, stored)


def spread(found: DataFrame, names: dict[float, str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (by..., metric) with each percentile in a column of its own."""
    picks = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(n) for p, n in names.items()]
    return found.groupBy(*by, "metric").agg(*picks)
