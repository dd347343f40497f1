"""Streaming intake of delivered month files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripmill.plans.processing import derive_v1
from tripmill.session import settle
from tripmill.sources.publish import Publication, new_run_id
from tripmill.sources.writers import MONTH_PARTITION, write_partitioned

DELIVERY_PARTITION = ("file_year", "file_month")
# Month of a file: a year-month between separators of its name, or folders file_year=/file_month=.
MONTH_IN_NAME = r"(?:^|[/_.])(\d{4})-(0[1-9]|1[0-2])(?=[_.][^/]*$)"
MONTH_IN_FOLDER = r"/file_year=(\d{4})/file_month=(0?[1-9]|1[0-2])/"
# A date behind the month tells deliveries of one folder apart.
STAMP_IN_NAME = r"\d{4}-\d{2}_(\d{8})(?=[_.][^/]*$)"

LEDGER = "file_year int, file_month int, delivery struct<stamp: string, folder: string>, newest timestamp"

Derive = Callable[[DataFrame], DataFrame]


def stream_files(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Newly arrived Parquet files below ``folder``."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def stream_land_files(
    spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, derive: Derive = derive_v1
) -> StreamingQuery:
    """Clean and derive every file not seen yet, append by pickup month, then stop.

    The file sink's log keeps a restarted run from storing a file twice.
    """
    return (
        derive(stream_files(spark, folder, schema))
        .writeStream.format("parquet")
        .partitionBy(*MONTH_PARTITION)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


LANDED_PARTITION = (*MONTH_PARTITION, "batch")
# Rows that a task of a compaction reads and writes.
COMPACT_ROWS = 500_000


def stream_land_batches(
    spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, max_bytes: int = 10 << 30, derive: Derive = derive_v1
) -> StreamingQuery:
    """Land a backlog in batches of about ``max_bytes`` of files each; readers follow a manifest (:class:`Publication`).

    A batch is rebalanced by pickup month before columns are derived (after it, for
    files without raw pickup times), so many small files become few, and published
    in one step. Its rows stand under its own number: a batch
    that runs again after a failure replaces what it had stored, and adds nothing.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        raw = "tpep_pickup_datetime" in batch.columns
        if raw:
            batch = batch.withColumn("_month", F.year("tpep_pickup_datetime") * 12 + F.month("tpep_pickup_datetime")).hint("rebalance", "_month").drop("_month")
        land_batch(derive(batch), batch_id, out, spread=not raw)

    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxBytesPerTrigger", str(max_bytes))
        .parquet(folder)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_batch(rows: DataFrame, batch_id: int, out: str, spread: bool = True) -> int:
    """Publish the rows of one batch under its number; returns the rows. Without ``spread`` they lie by month already."""
    tables = Publication(rows.sparkSession, out)
    staged = tables.stage(rows.withColumn("batch", F.lit(batch_id)), "trips", f"batch{batch_id}", LANDED_PARTITION, spread=spread)
    tables.publish([staged], [])
    return staged.observed["rows"]


def compact_batches(spark: SparkSession, out: str, least: int = 2) -> int:
    """Rewrite each month that lies in ``least`` or more batches as one; returns the months rewritten.

    The newest batch is left out, as it may run again. Readers see the old parts or
    the new one: both change with one publication. Parts lie by month, so tasks of
    one month each read and write them and no row is shuffled.
    """
    tables = Publication(spark, out)
    parts = tables.live().where((F.col("table_name") == "trips") & F.col("folder").isNotNull())
    parts = parts.withColumn("_batch", F.regexp_extract("part", r"/batch=(\d+)$", 1).cast("long"))
    newest = parts.agg(F.max("_batch")).first()[0]
    months = parts.where(F.col("_batch") < (newest or 0)).groupBy(F.regexp_replace("part", "/batch=.*$", "").alias("month"))
    chosen = months.agg(F.collect_list("part").alias("parts"), F.max("_batch").alias("last")).where(F.size("parts") >= least).collect()  # a row per month
    if not chosen:
        return 0
    old = [part for row in chosen for part in row["parts"]]
    last = max(row["last"] for row in chosen)
    rows = tables.read_apart("trips", [row["parts"] for row in chosen], COMPACT_ROWS).withColumn("batch", F.lit(last).cast("int"))
    staged = tables.stage(rows, "trips", f"compact{last}-{new_run_id()}", LANDED_PARTITION, spread=False)
    tables.publish([staged], old)
    return len(chosen)


def _month_part(group: int, pattern: str) -> Column:
    path = F.col("_path")
    named, folder = F.regexp_extract(path, pattern, group), F.regexp_extract(path, MONTH_IN_FOLDER, group)
    return F.coalesce(folder.try_cast("int"), named.try_cast("int"))


def with_file(source: DataFrame) -> DataFrame:
    """Rows with the path and time of their file."""
    return source.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_delivered"))


def deliveries(batch: DataFrame, pattern: str = MONTH_IN_NAME) -> DataFrame:
    """A row for each file of a batch (:func:`with_file`): its month (null if it tells none), its delivery and its time.

    A delivery is everything of one month that arrives in one folder under one
    stamp, however many files it has. Paths are parsed once a file, not once a row,
    and no column of the rows is read for it.
    """
    path = F.col("_path")
    return batch.groupBy("_path").agg(F.max("_delivered").alias("delivered")).select(
        "_path",
        _month_part(1, pattern).alias("file_year"),
        _month_part(2, pattern).alias("file_month"),
        F.struct(F.regexp_extract(path, STAMP_IN_NAME, 1).alias("stamp"), F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("folder")).alias("delivery"),
        "delivered",
    )


def latest_delivery(batch: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The last delivery of each file month, if files of it are in the batch: by stamp, then by the time of its newest file.

    ``stored`` has the delivery that each month's stored rows belong to; ``held``
    tells whether the chosen one is that. ``batch`` has a row per file
    (:func:`deliveries`); deliveries are compared one row per delivery.
    """
    month = list(DELIVERY_PARTITION)
    seen = batch.groupBy(*month, "delivery").agg(F.max("delivered").alias("newest")).withColumn("held", F.lit(False))
    if stored is not None:
        seen = seen.union(stored.select(*month, "delivery", "newest", F.lit(True)))
    per_delivery = seen.groupBy(*month, "delivery").agg(
        F.max("newest").alias("newest"), F.bool_or("held").alias("held"), F.bool_or(~F.col("held")).alias("_arrived")
    )
    newest = Window.partitionBy(*month).orderBy(F.desc("delivery.stamp"), F.desc("newest"), F.desc("delivery.folder"))
    chosen = per_delivery.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1 AND _arrived")
    return chosen.drop("_rank", "_arrived")


def _keep_only(spark: SparkSession, folder: str, name: str) -> None:
    """Delete everything in ``folder`` except ``name``; the folder may be absent."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if store.exists(path):
        for status in store.listStatus(path):
            if status.getPath().getName() != name:
                store.delete(status.getPath(), True)


def stream_replace_months(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    derive: Derive = derive_v1,
    pattern: str = MONTH_IN_NAME,
    rejected: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Like :func:`stream_land_files`, but a month delivered again replaces the
    rows stored for it.

    The month is the one that the file's name or folder tells: a January file may
    hold a few December trips, and they must not replace December. Which delivery
    a month's rows belong to is kept below ``ledger`` (default: ``out`` with
    ``-deliveries``): more files of it are added in later batches, a newer one
    replaces it, an older one is left out. Deliveries are chosen before rows are
    cleaned, so one that cleaning empties still empties its month. Rows are stored
    by month and ``delivery_batch``, by the tasks that read their files (without a shuffle, in
    no more files than parts of delivered files are read), and a batch decides from the ledger of the
    batches before it, so repeating it is harmless. Rows of files that tell no
    month are stored as they are below ``rejected`` (default: ``out`` with
    ``-rejected``), by batch.
    """
    rejected = rejected or f"{out.rstrip('/')}-rejected"
    ledger = ledger or f"{out.rstrip('/')}-deliveries"
    month = list(DELIVERY_PARTITION)
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(f"{ledger}/delivery_batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        known = F.col("file_year").isNotNull() & F.col("file_month").isNotNull()
        # what follows works on a row per file; stored, so its real size picks the join and rows are not shuffled for it
        found = settle(deliveries(batch, pattern), "files")
        lost = found.where(~known).select("_path")
        if not lost.isEmpty():
            batch.join(lost, "_path", "left_semi").select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        arrived = found.where(known)
        before = own.read.schema(f"{LEDGER}, delivery_batch bigint").parquet(ledger).where(F.col("delivery_batch") < batch_id)
        last = before.groupBy(*month).agg(F.max_by(F.struct("delivery", "newest"), "delivery_batch").alias("_last"))
        chosen = settle(latest_delivery(arrived, last.select(*month, "_last.*")), "deliveries")
        wanted = settle(arrived.join(chosen.select(*month, "delivery"), [*month, "delivery"], "left_semi").select("_path", *month), "wanted-files")
        # a file holds rows of one month, so its rows are stored by the tasks that read them
        rows = batch.drop("_delivered").join(wanted, "_path").drop("_path")
        write_partitioned(derive(rows).withColumn("delivery_batch", F.lit(batch_id)), out, [*month, "delivery_batch"], spread=False, compression="zstd")
        for year, number in chosen.where(~F.col("held")).select(*month).collect():  # one row per month
            _keep_only(own, f"{out}/file_year={year}/file_month={number}", f"delivery_batch={batch_id}")
        chosen.drop("held").write.mode("overwrite").parquet(f"{ledger}/delivery_batch={batch_id}")

    return (
        with_file(stream_files(spark, folder, schema))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
