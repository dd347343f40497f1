"""Sinks: partitioned tables, metric tables, views and SQL scripts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schemas import ANALYTICS_TRIP
from tripmill.sources.files import conform

# Layout of the stored trip tables.
MONTH_PARTITION = ("pickup_year", "pickup_month")
DAY_PARTITION = ("pickup_date",)
DAY_CLUSTER = ("pickup_hour", "payment_type_desc")
ANALYTICS_CLUSTER = ("pickup_location_id", "payment_type", "time_of_day")


def write_partitioned(
    df: DataFrame,
    path: str,
    partition: Iterable[str] = MONTH_PARTITION,
    cluster: Iterable[str] = (),
    mode: str = "overwrite",
    replace: str = "partitions",
    max_records_per_file: int = 20_000_000,
    spread: bool = True,
    compression: str | None = None,
) -> None:
    """Parquet folders per partition value.

    Overwriting replaces the partitions written, or with ``replace="all"``
    everything stored at ``path``.

    Rows are rebalanced by partition value: values holding many rows are split
    over several tasks, small ones share a task, so one month with most of the
    data neither lands in a single task nor scatters into tiny files.
    ``cluster`` orders rows within a file so row groups can be skipped. Without
    ``spread`` rows are written where they are, for rows that lie by partition value already.
    ``compression`` names a codec of the files instead of the session's.
    """
    partition, cluster = list(partition), list(cluster)
    if spread:
        df = df.hint("rebalance", *partition)
    if cluster:
        df = df.sortWithinPartitions(*partition, *cluster)
    writer = (
        df.write.mode(mode).partitionBy(*partition).option("maxRecordsPerFile", max_records_per_file)
    )
    if compression:
        writer = writer.option("compression", compression)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static" if replace == "all" else "dynamic")
    writer.parquet(path)


def write_trips_by_day(df: DataFrame, path: str) -> None:
    """Replace a trip table stored by pickup day, ordered by hour and payment description."""
    write_partitioned(df, path, DAY_PARTITION, DAY_CLUSTER, replace="all")


def write_frames(frames: Mapping[str, DataFrame], root: str) -> list[str]:
    """One Parquet folder per named frame; returns the paths written."""
    paths = []
    for name, frame in frames.items():
        paths.append(f"{root}/{name}")
        frame.write.mode("overwrite").parquet(paths[-1])
    return paths


def write_metric(df: DataFrame, root: str, metric: str, year: int, month: int) -> str:
    """Overwrite the metric table of one month; returns its path."""
    path = f"{root}/{metric}/{year}_{month:02d}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_metric_months(df: DataFrame, root: str, metric: str) -> str:
    """Store a metric of all months, one folder per month; months not in ``df`` stay. Returns the path."""
    path = f"{root}/{metric}"
    write_partitioned(df, path)
    return path


def save_table(df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Store a query result as a catalogue table, at ``path`` if given."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def create_analytics_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType = ANALYTICS_TRIP
) -> None:
    """Drop and recreate an empty analytics table partitioned by pickup day.

    Dropping an external table leaves its files, so they are overwritten with
    nothing; a second run starts empty like the first.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("pickup_date").parquet(path)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (pickup_date) LOCATION '{path}'"
    )


def append_analytics(df: DataFrame, table: str, schema: T.StructType = ANALYTICS_TRIP) -> None:
    """Append conformed trips, clustered within each day's files."""
    balanced = conform(df, schema).hint("rebalance", "pickup_date")
    conformed = balanced.sortWithinPartitions("pickup_date", *ANALYTICS_CLUSTER)
    names = [n for n in schema.fieldNames() if n != "pickup_date"] + ["pickup_date"]
    conformed.select(*names).write.mode("append").format("parquet").partitionBy("pickup_date").saveAsTable(table)


def observed(seen: Observation, df: DataFrame, measures: Mapping[str, Column]) -> dict:
    """What a job observed of ``df``.

    Adaptive execution cuts a branch off once it knows that it is empty, and the
    observation with it; then the measures are taken by a pass of their own.
    """
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return found or df.agg(*[column.alias(name) for name, column in measures.items()]).first().asDict()


def truncate_load(df: DataFrame, path: str, schema: T.StructType) -> int:
    """Replace a table's content with conformed rows; returns the rows written.

    The count is observed while writing, not by a second pass.
    """
    seen, rows = Observation("load"), conform(df, schema)
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return observed(seen, rows, {"rows": F.count(F.lit(1))})["rows"]


def write_hash_distributed(
    df: DataFrame,
    table: str,
    buckets: int,
    key: str = "pickup_location_id",
    path: str | None = None,
    sort: Iterable[str] = (),
) -> None:
    """Table bucketed by ``key``, so joins and aggregates on it need no shuffle.

    Rows are rebalanced by the key first, which splits a key holding most rows
    over several tasks instead of leaving it to one.
    """
    writer = df.hint("rebalance", key).write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    ordering = list(sort)
    if ordering:
        writer = writer.sortBy(*ordering)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def create_view(spark: SparkSession, name: str, source: DataFrame | str) -> None:
    """Create or replace a temporary view over a frame or SQL text."""
    frame = spark.sql(source) if isinstance(source, str) else source
    frame.createOrReplaceTempView(name)


@dataclass(frozen=True)
class StatementResult:
    statement: str
    ok: bool
    error: str | None = None


# Quoted text, comments, or anything else up to a semicolon.
_SQL_PART = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^'\"`;/-]+|.", re.DOTALL)


def split_sql(text: str) -> list[str]:
    """Statements of a script; semicolons within quotes and comments do not end one."""
    statements, current = [], []
    for part in [*_SQL_PART.findall(text), ";"]:
        if part != ";":
            current.append("\n" if part.startswith(("--", "/*")) else part)
            continue
        statements.append("".join(current).strip())
        current = []
    return [s for s in statements if s]


def run_sql_script(spark: SparkSession, text: str) -> list[StatementResult]:
    """Run each statement of a script; a failure is reported in full and the rest still run."""
    results = []
    for statement in split_sql(text):
        try:
            spark.sql(statement)
            results.append(StatementResult(statement, True))
        except Exception as error:  # noqa: BLE001 - any failure is part of the report
            results.append(StatementResult(statement, False, str(error)))
    return results
