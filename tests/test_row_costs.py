"""Steps whose cost follows files, months and stored columns, not derived rows."""

import os
import re

from pyspark.sql import functions as F

from tests.test_flows import at, one_file
from tripmill.operators import sizing, zones
from tripmill.plans import processing, registered
from tripmill.sources import files, publish, writers
from tripmill.streaming import landing


def test_paths_are_parsed_once_a_file(spark, make_trips, tmp_path):
    source = str(tmp_path / "in")
    os.makedirs(source)
    for name, day in (("yellow_2023-03.parquet", 1), ("yellow_2023-03_20230401.parquet", 2), ("other.parquet", 3)):
        one_file(make_trips(at(day), at(day), at(day)), source, name)
    found = landing.deliveries(landing.with_file(spark.read.parquet(source)))
    rows = {(r.file_year, r.file_month, r.delivery.stamp) for r in found.collect()}
    assert found.count() == 3 and rows == {(2023, 3, ""), (2023, 3, "20230401"), (None, None, "")}
    steps = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [step for step in steps[1 + next(i for i, step in enumerate(steps) if "Aggregate" in step) :] if "Relation" not in step]
    assert below and not any(re.search("regexp_extract|fare_amount", step) for step in below)  # nor is any column of the rows read


def test_compaction_moves_no_rows_between_tasks(spark, make_trips, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    for number in range(4):
        landing.land_batch(processing.derive_v1(make_trips(*[at(1 + number, month=m) for m in (3, 4, 5)])), number, out)
    tables = publish.Publication(spark, out)
    groups = [[f"pickup_year=2023/pickup_month={m}/batch={b}" for b in range(3)] for m in (3, 4, 5)]
    rows = tables.read_apart("trips", groups, 2)
    months = rows.select("pickup_month", F.spark_partition_id().alias("task")).distinct().groupBy("task").count()
    assert rows.count() == 9 and months.where("count > 1").count() == 0  # tasks of one month each
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    spread = []
    real = publish.write_partitioned
    monkeypatch.setattr(publish, "write_partitioned", lambda *args, **options: (spread.append(options["spread"]), real(*args, **options)))
    assert landing.compact_batches(spark, out) == 3 and spread == [False]
    assert tables.read("trips").count() == 12


def test_delivered_months_are_stored_where_they_are_read(spark, make_trips, tmp_path, monkeypatch):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    months = {"file_year": F.year("tpep_pickup_datetime"), "file_month": F.month("tpep_pickup_datetime")}
    trips = make_trips(*[at(day, month=m) for m in (3, 4, 5) for day in range(1, 6)])
    writers.write_partitioned(trips.withColumns(months), root, processing.FILE_MONTH)
    raw = files.scan_deliveries(spark, root, keep=("trip_id",), task_bytes=1)
    where = raw.select("file_month", F.spark_partition_id().alias("task")).distinct().groupBy("task").count()
    assert where.where("count > 1").count() == 0 and raw.rdd.getNumPartitions() > 1
    whole = files.scan_deliveries(spark, root, keep=("trip_id",))
    assert raw.columns == whole.columns and raw.count() == 15 and raw.exceptAll(whole).count() == 0
    spread = []
    real = publish.write_partitioned
    monkeypatch.setattr(publish, "write_partitioned", lambda *args, **options: (spread.append(options["spread"]), real(*args, **options)))
    run = processing.process_v2_months(spark, root, out)
    assert spread == [False] and run.metrics["record_count"] == run.metrics["rows_read"] == run.read("analytics").count() == 15


def _shuffles(frame):
    """Steps below a frame that shuffle its rows."""
    return re.findall("REBALANCE|SortMergeJoin|ShuffledHashJoin", frame._jdf.queryExecution().executedPlan().toString())


def test_flows_over_delivered_months_store_rows_where_they_are_read(spark, make_trips, tmp_path, monkeypatch):
    root, lookup = str(tmp_path / "in"), tmp_path / "zones.csv"
    months = {"file_year": F.year("tpep_pickup_datetime"), "file_month": F.month("tpep_pickup_datetime")}
    trips = make_trips(*[{**at(day, month=m), "trip_distance": float(day), "total_amount": 10.0 + day} for m in (3, 4, 5) for day in range(1, 6)])
    writers.write_partitioned(trips.withColumns(months), root, processing.FILE_MONTH)
    lookup.write_text("LocationID,Borough,Zone\n1,North,A\n2,South,B\n")
    spread, shuffled = [], []
    real = publish.write_partitioned

    def watched(df, path, *args, **options):
        if "enriched" in path:
            spread.append(options["spread"])
            shuffled.append(_shuffles(df))
        real(df, path, *args, **options)

    monkeypatch.setattr(publish, "write_partitioned", watched)
    run = processing.process_v4_months(spark, root, str(lookup), str(tmp_path / "out"))
    stored = {(r.file_month, r["count"]) for r in run.read("enriched").groupBy("file_month").count().collect()}
    assert spread == [False] and shuffled == [[]] and stored == {(3, 4), (4, 4), (5, 4)}  # the dearest trip of each month is not below the 99th percentile
    monkeypatch.setattr(zones, "fits_broadcast", lambda _: False)
    again = processing.process_v4_months(spark, root, str(lookup), str(tmp_path / "again"))
    assert spread == [False, True]  # joins that shuffle leave rows anywhere
    assert again.read("enriched").exceptAll(run.read("enriched")).count() == 0 and again.metrics["record_count"] == 12


def test_a_lookup_is_held_by_its_bytes(spark):
    lookup = spark.range(300).selectExpr("CAST(id AS int) AS LocationID", "'North' AS Borough", "IF(id = 0, NULL, repeat('z', 20)) AS Zone")
    size = sizing.held_bytes(lookup)
    assert 300 * 64 < size < 300 * 200
    assert sizing.fits_broadcast(lookup, 300, 0) and sizing.fits_broadcast(lookup, 299, size) and not sizing.fits_broadcast(lookup, 299, size - 1)
    assert sizing.fits_broadcast(lookup.limit(0), 0, 0)


def test_delivered_trips_are_dealt_as_order_lines(spark, small):
    tables = registered.Tables(spark, small)
    dealt, plain = tables.raw_by_month(), tables.raw()
    assert dealt.schema == plain.schema and dealt.exceptAll(plain).count() == plain.exceptAll(dealt).count() == 0
    steps = dealt.where(F.xxhash64("trip_id") % 2 == 0)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at_shuffle = next(i for i, step in enumerate(steps) if "RebalancePartitions" in step)
    assert "concat_ws" in steps[at_shuffle - 1] and "concat_ws" not in steps[at_shuffle + 1]  # trips are made above it
    assert "Filter" not in "".join(steps[:at_shuffle]) and any("xxhash64" in step for step in steps[at_shuffle:])  # and left out below it


def test_the_run_of_flow_metrics_stores_months_where_they_are_read(spark, small, monkeypatch):
    spread, real = [], publish.write_partitioned
    monkeypatch.setattr(publish, "write_partitioned", lambda *args, **options: (spread.append(options["spread"]), real(*args, **options)))
    registered.builders()["flow_run_metrics"](registered.Tables(spark, small))
    assert spread == [False]


def test_replaced_months_are_stored_by_the_tasks_that_read_them(spark, make_trips, tmp_path, monkeypatch):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    for month in (2, 3):
        os.makedirs(f"{source}/file_year=2023/file_month={month}")
        for name, day in (("part-00000-a.parquet", 1), ("part-00001-a.parquet", 3)):
            one_file(make_trips(at(day, month=month), at(day + 1, month=month)), f"{source}/file_year=2023/file_month={month}", name)
    shuffled, real = [], landing.write_partitioned
    monkeypatch.setattr(landing, "write_partitioned", lambda df, *args, **options: (shuffled.append(_shuffles(df)), real(df, *args, **options)))
    landing.stream_replace_months(spark, source, make_trips(at(1)).schema, out, log).awaitTermination()
    stored = spark.read.parquet(out)
    assert shuffled == [[]] and {(r.file_month, r["count"]) for r in stored.groupBy("file_month").count().collect()} == {(2, 4), (3, 4)}
    assert len(stored.inputFiles()) <= 4  # no more files than were delivered
