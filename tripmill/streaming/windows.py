"""Event-time counts over a stream of trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def hourly_counts(
    stream: DataFrame, when: str = "tpep_pickup_datetime", delay: str = "1 hour", value: str = "total_amount", distinct: Sequence[str] = (), undated: bool = False
) -> DataFrame:
    """Tumbling one-hour counts and average of ``value``; rows later than ``delay`` are dropped.

    With ``distinct``, a row whose key columns were seen within the delay counts
    once; the keys seen are forgotten as the watermark passes them, so the state
    does not grow with the stream. Works on batch frames too, where the watermark
    has no effect. With ``undated``, rows without a time form a group without an
    hour; such counts are for ``complete`` output, which drops no late rows either.
    """
    timed = stream.withColumn("_ts", F.col(when).cast("timestamp")).withWatermark("_ts", delay)
    if distinct:
        timed = timed.dropDuplicatesWithinWatermark(list(distinct)) if stream.isStreaming else timed.dropDuplicates(list(distinct))
    hour = F.struct(F.date_trunc("hour", "_ts").alias("start")) if undated else F.window("_ts", "1 hour")
    return (
        timed.groupBy(hour.alias("_w"))
        .agg(F.count(F.lit(1)).alias("trips_per_hour"), F.avg(value).alias("avg_fare_per_hour"))
        .select(F.col("_w.start").alias("hour_start"), "trips_per_hour", "avg_fare_per_hour")
    )


def dropped_rows(query: StreamingQuery) -> dict[str, int]:
    """What a drained query left out, from its own progress: rows behind the watermark, and repeated rows."""
    late = repeated = rows = 0
    for progress in query.recentProgress:
        rows += progress["numInputRows"]
        for operator in progress["stateOperators"]:
            late += operator["numRowsDroppedByWatermark"]
            repeated += (operator.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0)
    return {"input_rows": rows, "late_rows": late, "repeated_rows": repeated}


def write_counts(counts: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """Drain the available input into a Parquet folder.

    ``append`` emits an hour once the watermark has passed it. ``complete``
    rewrites the table of hours with every batch, open hours included.
    """

    if mode == "append":
        writer = counts.writeStream.format("parquet").option("path", path).outputMode("append")
    else:

        def rewrite(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        writer = counts.writeStream.foreachBatch(rewrite).outputMode(mode)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
