"""File sources: trip files, month folders, zone CSV and the delivery inventory."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import schemas


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files with the schema their footers declare."""
    return spark.read.parquet(path)


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """A scan over fewer splits than there are cores, spread over all of them by ``key``.

    A file with one row group is read by one task however large the cluster.
    Scans with enough splits, as any large table has, are left alone, so no
    large table is shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def scan_month(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """One month of a table laid out as ``pickup_year=/pickup_month=`` folders.

    The filter is on partition columns: all folders are listed, and only that
    month's files are opened.
    """
    return spark.read.parquet(root).where((F.col("pickup_year") == year) & (F.col("pickup_month") == month))


def fitted(column: Column, actual: T.DataType, wanted: T.DataType) -> Column:
    """A source column as the declared type; null where the value does not fit.

    Numbers widen. Fractions fit whole-number types only if they are whole, and
    numbers only within the range of the type. Text fits what it spells. Other
    pairs of types (a date for a number) fit nothing.
    """
    if actual == wanted:
        return column
    whole = isinstance(wanted, T.IntegralType)
    if isinstance(actual, T.StringType):
        return F.try_to_timestamp(F.trim(column)) if isinstance(wanted, T.TimestampType) else F.trim(column).try_cast(wanted)
    if whole and isinstance(actual, (T.FractionalType, T.DecimalType)):
        return F.when(column == F.floor(column), column.try_cast(wanted))
    alike = (T.NumericType,), (T.BooleanType,), (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(wanted, T.StringType) or any(isinstance(actual, kinds) and isinstance(wanted, kinds) for kinds in alike):
        return column.try_cast(wanted)
    return F.lit(None).cast(wanted)


def rename_spellings(df: DataFrame, spellings: Mapping[str, str] = schemas.SOURCE_SPELLINGS) -> DataFrame:
    """Column names to raw style: lower case, published spellings mapped."""
    names = [spellings.get(name.lower(), name.lower()) for name in df.columns]
    return df.toDF(*names)


def conform(df: DataFrame, schema: T.StructType, reject_column: str | None = None) -> DataFrame:
    """Select exactly ``schema``: cast what fits, null for absent columns.

    With ``reject_column`` set, adds the number of values of the row that were
    present but did not fit their declared type.
    """
    present = set(df.columns)
    targets = {
        f.name: fitted(F.col(f.name), df.schema[f.name].dataType, f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        for f in schema
    }
    selected = [column.alias(name) for name, column in targets.items()]
    if reject_column:
        misfits = [
            (F.col(name).isNotNull() & column.isNull()).cast("int")
            for name, column in targets.items()
            if name in present
        ]
        total = misfits[0]
        for flag in misfits[1:]:
            total = total + flag
        selected.append(total.alias(reject_column))
    return df.select(*selected)


def scan_raw_trips(
    spark: SparkSession, path: str, strict: bool = False, reject_column: str | None = None
) -> DataFrame:
    """Trip files in the declared 18-field layout.

    ``strict`` reads with the declared schema and fails on other physical
    types; otherwise names and types are normalised and misfits become null.
    """
    if strict:
        return spark.read.schema(schemas.RAW_TRIP).parquet(path)
    return conform(rename_spellings(scan_parquet(spark, path)), schemas.RAW_TRIP, reject_column)


def delivery_folders(spark: SparkSession, root: str, pattern: str = "*.parquet") -> list[str]:
    """Folders below ``root`` that hold data files: listed without opening a file, one row per folder."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    folders = listing.select(F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).distinct()
    return sorted(row["folder"] for row in folders.collect())


def folder_bytes(spark: SparkSession, root: str, pattern: str = "*.parquet") -> dict[str, int]:
    """Bytes of the data files of each folder below ``root``, listed without opening a file."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    sizes = listing.groupBy(F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).agg(F.sum("length").alias("bytes"))
    return {row["folder"]: row["bytes"] for row in sizes.collect()}  # one row per folder


def layouts(spark: SparkSession, folders: Sequence[str], readers: int = 16) -> list[tuple[T.StructType, list[str]]]:
    """Folders grouped by the columns and types that their footers declare.

    A delivery is written by one writer, so one footer speaks for its folder;
    footers of many folders are read at the same time.
    """
    found: dict[tuple, tuple[T.StructType, list[str]]] = {}
    with ThreadPoolExecutor(readers) as pool:
        for folder, schema in zip(folders, pool.map(lambda f: spark.read.parquet(f).schema, folders)):
            layout = tuple((f.name, f.dataType.simpleString()) for f in schema)
            found.setdefault(layout, (schema, []))[1].append(folder)
    return list(found.values())


def scan_deliveries(
    spark: SparkSession,
    root: str,
    schema: T.StructType = schemas.RAW_TRIP,
    keep: Sequence[str] = (),
    reject_column: str | None = None,
    months: Sequence[tuple[int, int]] | None = None,
    task_bytes: int | None = None,
) -> DataFrame:
    """Month folders (``file_year=/file_month=``) of different layouts as one frame of the declared fields.

    Folders are grouped by footer; each group is read with its own types and
    conformed column by column (:func:`fitted`), then all are united. Columns
    named in ``keep`` stay as text. With ``reject_column``, each row tells how many
    of its values did not fit. The plan has one branch per layout, whatever the
    number of folders, and only the given ``months`` are read. With ``task_bytes``
    there is one branch per folder instead, read in tasks of about so many bytes
    that hold rows of no other folder.
    """
    wanted = T.StructType([*schema.fields, *[T.StructField(name, T.StringType()) for name in keep if name not in schema.fieldNames()]])
    month = ("file_year", "file_month")
    folders = delivery_folders(spark, root)
    if months is not None:
        found = [re.search(r"/file_year=(\d+)/file_month=(\d+)$", folder) for folder in folders]
        folders = [m.string for m in found if m and (int(m[1]), int(m[2])) in set(months)]
    frames = []
    found = layouts(spark, folders)
    if task_bytes:
        sizes = folder_bytes(spark, root)
        found = [(layout, [folder]) for layout, own in found for folder in own]
    for layout, own in found:
        read = T.StructType([*layout.fields, *[T.StructField(name, T.IntegerType()) for name in month]])
        stored = spark.read.schema(read).option("basePath", root).parquet(*own)
        if task_bytes:  # two at least: frames of a single task each would be united in a single task
            stored = stored.coalesce(max(2, -(-sizes[own[0]] // task_bytes)))
        raw = rename_spellings(stored)
        numbered = raw.withColumns({f"_{name}": F.col(name) for name in month})
        frames.append(conform(numbered, T.StructType([*wanted.fields, *[T.StructField(f"_{name}", T.IntegerType()) for name in month]]), reject_column))
    if not frames:
        empty = T.StructType([*wanted.fields, *[T.StructField(name, T.IntegerType()) for name in month]])
        none = spark.createDataFrame([], empty)
        return none.withColumn(reject_column, F.lit(0)) if reject_column else none
    united = reduce(DataFrame.unionByName, frames)
    return united.withColumnsRenamed({f"_{name}": name for name in month})


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header; the id is read as an integer."""
    return spark.read.schema(schemas.ZONE).csv(path, header=True)


def file_inventory(
    spark: SparkSession, path: str, as_of: Column | None = None, max_age_hours: float = 24, pattern: str = "*.parquet"
) -> DataFrame:
    """Delivered files with size, age and whether each passes the arrival check.

    Lists files without opening them: the content column is never selected.
    Files without content are not listed; :func:`expected_files` reports them.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    )
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("modified")) / 3600
    return listing.withColumn("age_hours", age).withColumn(
        "accepted", (F.col("size_bytes") > 0) & (F.col("age_hours") <= max_age_hours)
    )


def expected_files(inventory: DataFrame, expected: DataFrame, name: str = "file_name") -> DataFrame:
    """Each expected file name and whether it was delivered, fresh and not empty."""
    listed = inventory.select(
        F.element_at(F.split("path", "/"), -1).alias(name), "size_bytes", "age_hours", F.col("accepted").alias("_ok")
    )
    found = expected.select(name).join(listed, name, "left")
    return found.withColumn("accepted", F.coalesce("_ok", F.lit(False))).drop("_ok")
