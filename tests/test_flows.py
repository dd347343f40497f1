"""Sources, sinks, streams and composed flows on small files."""

from __future__ import annotations

import os
import time
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.functions import features, profiles
from tripmill.operators import bundles, cluster, quality, sampling, zones
from tripmill.operators.reports import Report, std
from tripmill.plans import catalog, processing, registered
from tripmill.session import shared_dir
from tripmill.sources import files, publish, synthetic, tables, writers
from tripmill.streaming import landing, windows

NOON = datetime(2023, 3, 1, 12, 0, 0)


def at(day: int, hour: int = 12, month: int = 3) -> dict:
    start = datetime(2023, month, day, hour)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + timedelta(minutes=20)}


def one_file(df, folder, name: str) -> str:
    """``df`` as a single Parquet file of that name."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/.tmp-{name}")
    part = next(p for p in os.listdir(f"{folder}/.tmp-{name}") if p.endswith(".parquet"))
    target = f"{folder}/{name}"
    os.replace(f"{folder}/.tmp-{name}/{part}", target)
    return target


def test_conform_casts_renames_and_counts_misfits(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame(
        [("2023-01-01 10:00:00", "1", 2.5, 7), ("bad", "x", 3.5, 8)],
        "Pickup_Datetime string, passenger_count string, trip_distance double, PULocationID int",
    ).write.parquet(path)
    df = files.scan_raw_trips(spark, path, reject_column="misfits")
    assert df.columns == [*schemas.RAW_TRIP.fieldNames(), "misfits"]
    rows = sorted(df.collect(), key=lambda r: r.misfits)
    assert [r.misfits for r in rows] == [0, 2]
    assert rows[1].tpep_pickup_datetime is None and rows[1].pu_location_id == 8


def test_zone_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone\n1,North,A\n2,South,B\n")
    df = files.scan_zones(spark, str(path))
    assert dict(df.dtypes)["LocationID"] == "int" and df.count() == 2


def test_file_inventory(spark, tmp_path):
    good, old, empty = (tmp_path / n for n in ("a.parquet", "b.parquet", "c.parquet"))
    good.write_bytes(b"x")
    old.write_bytes(b"x")
    empty.write_bytes(b"")
    os.utime(old, (time.time() - 90_000,) * 2)
    inventory = files.file_inventory(spark, str(tmp_path))
    assert {r.path.rsplit("/", 1)[-1]: r.accepted for r in inventory.collect()} == {"a.parquet": True, "b.parquet": False}
    expected = spark.createDataFrame([("a.parquet",), ("c.parquet",), ("d.parquet",)], "file_name string")
    checked = files.expected_files(inventory, expected)
    assert {r.file_name: r.accepted for r in checked.collect()} == {"a.parquet": True, "c.parquet": False, "d.parquet": False}


def test_month_scan_prunes_partitions(spark, make_trips, tmp_path):
    path = str(tmp_path / "t")
    trips = features.add_features(make_trips(at(1), at(2), at(1, month=4)), profiles.V1)
    writers.write_partitioned(trips, path)
    scan = files.scan_month(spark, path, 2023, 3)
    assert scan.count() == 2
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_year" in plan


def test_overwrite_replaces_only_written_months(spark, make_trips, tmp_path):
    path = str(tmp_path / "t")

    def v1(*rows):
        return features.add_features(make_trips(*rows), profiles.V1)

    writers.write_partitioned(v1(at(1), at(2), at(1, month=4)), path)
    writers.write_partitioned(v1(at(5)), path)
    assert files.scan_month(spark, path, 2023, 3).count() == 1
    assert files.scan_month(spark, path, 2023, 4).count() == 1
    writers.write_partitioned(v1(at(5)), path, replace="all")
    assert spark.read.parquet(path).count() == 1


def test_analytics_table_and_bucketed_table(spark, make_trips, tmp_path):
    derived = processing.derive_v2(make_trips(*[at(d, d) for d in range(1, 11)]))
    writers.create_analytics_table(spark, "analytics_t", str(tmp_path / "a"))
    writers.append_analytics(derived, "analytics_t")
    writers.append_analytics(derived, "analytics_t")
    stored = tables.scan_table(spark, "analytics_t")
    assert stored.count() == 20
    assert set(stored.columns) == set(schemas.ANALYTICS_TRIP.fieldNames())
    writers.write_hash_distributed(stored, "bucketed_t", 4, path=str(tmp_path / "b"))
    counts = spark.table("bucketed_t").groupBy("pickup_location_id").count()
    assert "Exchange hashpartitioning" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.first()["count"] == 20


def test_truncate_load_reports_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    sample = synthetic.sample_trips(spark, 500)
    assert writers.truncate_load(sample, path, schemas.SAMPLE_TRIP) == 500
    assert writers.truncate_load(sample.limit(10), path, schemas.SAMPLE_TRIP) == 10
    assert spark.read.parquet(path).count() == 10


def test_synthetic_trips_stay_in_range_and_repeat(spark):
    a, b = synthetic.sample_trips(spark, 2000), synthetic.sample_trips(spark, 2000)
    assert a.exceptAll(b).count() == 0
    row = a.agg(
        F.min("trip_duration_minutes"), F.max("trip_duration_minutes"), F.min("pickup_location_id"),
        F.max("pickup_location_id"), F.min("trip_distance"), F.max("trip_distance"),
        F.count_distinct("payment_type"), F.count_distinct("trip_type"),
    ).first()
    assert row[0] >= 5 and row[1] <= 119 and row[2] >= 1 and row[3] <= 263
    assert row[4] >= 0.5 and row[5] < 30 and (row[6], row[7]) == (3, 2)
    assert a.where("abs(total_amount - fare_amount - tip_amount) > 1e-9").count() == 0


def test_sql_script_reports_failures_and_goes_on(spark):
    results = writers.run_sql_script(
        spark, "CREATE OR REPLACE TEMP VIEW one AS SELECT 1 AS x; SELECT * FROM nowhere;\nSELECT * FROM one;"
    )
    assert [r.ok for r in results] == [True, False, True]
    assert "nowhere" in results[1].error


def test_views_table_and_connector(spark, make_trips, tmp_path):
    derived = processing.derive_v2(make_trips(at(1), at(2)))
    assert processing.dashboard_views(spark, derived) == list(catalog.DASHBOARD_VIEWS)
    assert spark.table("view_geographic").first().trip_count == 2
    writers.save_table(catalog.REPORTS_V2["location_trip_counts"](derived), "saved_counts")
    assert tables.scan_table(spark, "saved_counts").count() == 1
    derived.write.json(str(tmp_path / "j"))
    assert tables.scan_table(spark, str(tmp_path / "j"), "json").count() == 2


def test_run_metrics_accumulate(spark, make_trips, tmp_path):
    path = str(tmp_path / "runs")
    counts = quality.dq_counts(make_trips({}), "tpep_pickup_datetime", "tpep_dropoff_datetime")
    for run in ("a", "b"):
        quality.append_run_metrics(quality.run_metrics(counts, run, flow="v1"), path)
    assert {r.run_id for r in spark.read.parquet(path).collect()} == {"a", "b"}


def test_samples_repeat_and_small_inputs_are_kept(spark, make_trips):
    df = spark.range(5000).select(F.col("id").cast("string").alias("trip_id")).repartition(7)
    first = {r.trip_id for r in sampling.sample_n(df).collect()}
    assert len(first) == 1000
    assert first == {r.trip_id for r in sampling.sample_n(df.repartition(3)).collect()}
    assert sampling.sample_n(df.limit(10)).count() == 10


def test_clusters_keep_every_location(spark):
    rows = [(i, 10 + i % 3 * 100, float(i % 3), float(i % 3), float(i % 3), float(i % 3)) for i in range(30)]
    profile = spark.createDataFrame(
        [*rows, (99, 5, 1.0, 1.0, 1.0, None)],
        "pickup_location_id int, total_trips long, avg_fare double, avg_distance double, avg_tip_percent double, avg_speed double",
    )
    found = cluster.location_clusters(profile, 3).collect()
    assert len(found) == 31
    by_location = {r.pickup_location_id: r.cluster for r in found}
    assert by_location[99] is None
    assert [by_location[i] for i in range(6)] == [0, 1, 2, 0, 1, 2]


def test_flow_v1(spark, make_trips, tmp_path):
    source = str(tmp_path / "in.parquet")
    make_trips(at(1), at(1, 13), at(2), {"trip_distance": 0.0}).write.parquet(source)
    run = processing.process_v1(spark, source, str(tmp_path / "out"), 2023, 3)
    assert run.read("trips").count() == 3
    assert (run.metrics["rows_read"], run.metrics["record_count"], run.metrics["months"]) == (4, 3, 1)
    assert sum(r.total_trips for r in run.read("daily_metrics").collect()) == 3
    assert sum(r.trips_per_hour for r in run.read("hourly_metrics").collect()) == 3
    assert {(r.file_year, r.file_month) for r in run.read("payment_metrics").collect()} == {(2023, 3)}


def test_flow_v2(spark, make_trips, tmp_path):
    root = str(tmp_path / "lake")
    raw = make_trips(at(1), at(2), at(1, month=4))
    writers.write_partitioned(
        raw.withColumns({"pickup_year": F.year("tpep_pickup_datetime"), "pickup_month": F.month("tpep_pickup_datetime")}), root
    )
    stored = processing.process_v2(spark, root, "flow_v2_t", str(tmp_path / "t"), 2023, 3)
    assert stored.count() == spark.table("flow_v2_t").count() == 2
    assert spark.table("viz_payment_analysis_2023_03").first().payment_type_desc == "credit_card"
    assert {r.day_type for r in spark.table("viz_weekday_weekend_2023_03").collect()} == {"Weekday"}
    # another month leaves the first where it is, and the same month again replaces only itself
    for month, rows in ((4, 3), (3, 3)):
        assert processing.process_v2(spark, root, "flow_v2_t", str(tmp_path / "t"), 2023, month).count() == rows
    assert spark.table("viz_hourly_patterns_2023_04").first().total_trips == 1


def test_flow_v4(spark, make_trips, tmp_path):
    source, zone_path = str(tmp_path / "in.parquet"), tmp_path / "zones.csv"
    zone_path.write_text("LocationID,Borough,Zone\n1,North,A\n2,South,B\n")
    rows = [{**at(1 + i % 20), "trip_distance": 1 + i / 50, "total_amount": 5 + i / 50} for i in range(100)]
    make_trips(*rows, {"pu_location_id": 7}).write.parquet(source)
    run = processing.process_v4(spark, source, str(zone_path), str(tmp_path / "out"), 2023, 3)
    assert run.read("overall").first().total_trips == run.read("enriched").count() == 99
    assert run.read("popular_routes").first().trip_count == 99
    assert run.metrics["rows_read"] == 101


@pytest.fixture
def year(make_trips, tmp_path):
    """Twelve delivered months, month m with m good trips and a bad one."""
    root = str(tmp_path / "year")
    trips = make_trips(*[row for m in range(1, 13) for row in ([at(1 + i, month=m) for i in range(m)] + [{**at(28, month=m), "trip_distance": 0.0}])])
    months = {"file_year": F.year("tpep_pickup_datetime"), "file_month": F.month("tpep_pickup_datetime")}
    writers.write_partitioned(trips.withColumns(months), root, processing.FILE_MONTH)
    return root


def months_of(frame):
    return {r.file_month: r["count"] for r in frame.groupBy("file_month").count().collect()}


def test_months_run_twice_leave_twelve_months(spark, year, tmp_path):
    out, every = str(tmp_path / "out"), {m: m for m in range(1, 13)}
    for _ in range(2):
        for month in (1, 2, 3):
            run = processing.process_v1_months(spark, year, out, [(2023, month)])
    assert months_of(run.read("trips")) == {m: m for m in (1, 2, 3)}
    for _ in range(2):
        run = processing.process_v1_months(spark, year, out)
        assert run.metrics["rows_read"] == 78 + 12 and run.metrics["record_count"] == 78
    assert months_of(run.read("trips")) == every and run.version == 8
    for name, column in (("daily_metrics", "total_trips"), ("location_metrics", "pickups_count")):
        totals = run.read(name).groupBy("file_month").agg(F.sum(column).alias("count")).collect()
        assert {r.file_month: r["count"] for r in totals} == every
    assert run.tables.superseded().select("part").distinct().count() == 12
    assert run.tables.read("trips", ["file_year=2023/file_month=5"]).count() == 5


def test_a_run_outside_the_limits_publishes_nothing(spark, year, tmp_path):
    out = str(tmp_path / "out")
    run = processing.process_v1_months(spark, year, out, [(2023, 12)])
    strict = quality.Limits(min_records=1, min_success_rate=0.95)
    with pytest.raises(quality.QualityError, match="success rate"):
        processing.process_v1_months(spark, year, out, [(2023, 1), (2023, 12)], limits=strict)
    assert months_of(run.read("trips")) == {12: 12}
    assert run.tables.live().select(F.max("version")).first()[0] == 1
    loose = quality.Limits(min_records=1, min_success_rate=0.5)
    assert months_of(processing.process_v1_months(spark, year, out, [(2023, 1)], limits=loose).read("trips")) == {1: 1, 12: 12}


def test_a_month_without_good_trips_becomes_empty(spark, make_trips, tmp_path):
    out, good, bad = (str(tmp_path / n) for n in ("out", "good", "bad"))
    make_trips(at(1), at(2)).write.parquet(good)
    make_trips({**at(1), "trip_distance": 0.0}).write.parquet(bad)
    processing.process_v1(spark, good, out, 2023, 2)
    run = processing.process_v1(spark, good, out, 2023, 3)
    assert months_of(run.read("daily_metrics")) == {2: 2, 3: 2}
    run = processing.process_v1(spark, bad, out, 2023, 3)
    assert months_of(run.read("trips")) == months_of(run.read("daily_metrics")) == {2: 2}
    run = processing.process_v1(spark, bad, out, 2023, 2)
    assert run.read("trips").count() == 0 and "pickup_hour" in run.read("trips").columns


def test_publication_is_seen_whole_or_not_at_all(spark, tmp_path):
    tables = publish.Publication(spark, str(tmp_path / "p"))
    one = lambda *rows: spark.createDataFrame(list(rows), "k int, x int")
    with pytest.raises(ValueError, match="nothing is published"):
        tables.read("a")
    first = [tables.stage(one((1, 10), (2, 20)), "a", "r1", ["k"]), tables.stage(one((1, 1)), "b", "r1", ["k"])]
    assert tables.live().count() == 0  # staged is not visible
    assert tables.publish(first, ["k=1", "k=2"]) == 1
    assert len([f for f in os.listdir(tmp_path / "p" / "manifest") if f.endswith(".parquet")]) == 2  # the empty start, and one file for both tables
    second = tables.stage(one((2, 21), (3, 30), (None, 40)), "a", "r2", ["k"])
    assert sorted(tuple(r) for r in tables.read("a").collect()) == [(1, 10), (2, 20)]
    tables.publish([second], ["k=2"])
    rows = lambda: sorted((tuple(r) for r in tables.read("a").collect()), key=str)
    assert rows() == [(1, 10), (2, 21), (3, 30), (None, 40)]
    lost = tables.stage(one((1, 11)), "a", "r3", ["k"])
    tables.staged(lost).limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{tables.root}/{lost.folder}")
    with pytest.raises(publish.PublicationError, match="differ"):
        tables.publish([lost], ["k=1"])
    assert rows() == [(1, 10), (2, 21), (3, 30), (None, 40)]
    again = tables.stage(one((1, 12)), "a", "r3", ["k"])  # the same run, staged again
    assert tables.publish([again], ["k=1"]) == 3 and rows()[0] == (1, 12)
    with pytest.raises(ValueError, match="one run"):
        tables.publish([again, second], [])


def test_bundles_read_the_trips_once(spark, small, tmp_path):
    path = str(tmp_path / "t")
    registered.Tables(spark, small).v1().write.parquet(path)
    read, reports = spark.read.parquet(path), processing.metric_reports()
    cells = bundles.shared_cells(read, reports)
    assert cells._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    for name, report in reports.items():
        ours, direct = registered.rounded(bundles.roll_up(cells, report)), registered.rounded(report(read))
        assert ours.exceptAll(direct).count() == direct.exceptAll(ours).count() == 0
    with pytest.raises(ValueError, match="rolled up"):
        bundles.roll_up(cells, Report(("pickup_hour",), {"spread": std("total_amount")}))


def test_conditional_measures_roll_up(spark, make_trips):
    trips = processing.derive_v2(make_trips(at(1, 7), at(1, 12), {**at(4, 8), "total_amount": None}, {**at(5, 3), "pu_location_id": None}))
    reports = {n: catalog.REPORTS_V2[n] for n in ("payment_patterns", "revenue_by_location", "weekday_weekend_comparison")}
    cells = bundles.shared_cells(trips, reports)
    for report in reports.values():
        assert bundles.roll_up(cells, report).collect() == report(trips).collect()
    none = bundles.shared_cells(trips.limit(0), {"all": catalog.REPORTS_V4["overall_stats"]}, ["trip_id"])
    assert bundles.roll_up(none, replace(catalog.REPORTS_V4["overall_stats"], keys=())).first().total_trips == 0


def test_long_form_names_keys_and_measures(spark):
    frame = spark.createDataFrame([("a", 1, 2.5, None), (None, 2, None, 7)], "k string, n int, x double, y int")
    rows = sorted(tuple(r) for r in bundles.long_form({"p": frame}, {"p": ["k", "n"]}).fillna(-1).collect())
    assert rows == [("p", "-|2", "x", -1.0), ("p", "-|2", "y", 7.0), ("p", "a|1", "x", 2.5), ("p", "a|1", "y", -1.0)]


def test_deliveries_of_different_layouts(spark, make_trips, tmp_path):
    root = str(tmp_path / "in")
    old = make_trips(at(1, month=1), at(2, month=1)).withColumnsRenamed({"pu_location_id": "PULocationID"})
    old = old.withColumn("passenger_count", F.expr("IF(day(tpep_pickup_datetime) = 1, 2.0, 1.5)")).withColumn("tpep_dropoff_datetime", F.lit("soon"))
    new = make_trips(at(1, month=2)).withColumn("extra_column", F.lit(1)).withColumn("fare_amount", F.lit("12.5")).withColumn("payment_type", F.lit(2**40))
    for month, frame in ((1, old), (2, new), (3, new)):
        frame.write.parquet(f"{root}/file_year=2023/file_month={month}")
    found = files.scan_deliveries(spark, root, keep=("trip_id",), reject_column="misfits")
    assert len(files.layouts(spark, files.delivery_folders(spark, root))) == 2
    rows = sorted(found.collect(), key=lambda r: (r.file_month, r.tpep_pickup_datetime))
    assert [(r.file_month, r.passenger_count, r.misfits, r.fare_amount, r.payment_type, r.pu_location_id) for r in rows] == [
        (1, 2, 1, 10.0, 1, 1), (1, None, 2, 10.0, 1, 1), (2, 1, 1, 12.5, None, 1), (3, 1, 1, 12.5, None, 1),
    ]
    assert months_of(files.scan_deliveries(spark, root, months=[(2023, 3), (2022, 3)])) == {3: 1}
    assert files.scan_deliveries(spark, root, months=[]).count() == 0


def test_bundles_run(spark, small):
    trips = registered.Tables(spark, small).v2()
    bundle = processing.analysis_bundle(trips)
    assert {"peak_hours", "trend", "weekend_ttest", "heatmap"} <= set(bundle)
    for name in ("trend", "fare_boxes", "radar", "scatter"):
        assert bundle[name].limit(1).count() == 1
    run = processing.eda_run(trips)
    assert run["record_count"].first().record_count == trips.count()
    assert run["anomaly_counts"].count() > 0
    assert processing.quality_report(trips).where("NOT passed").count() == 0


def test_totals_agree_across_reports(spark, small):
    v1 = registered.Tables(spark, small).v1()
    n = v1.count()
    for name in catalog.METRIC_TABLES:
        table = catalog.REPORTS_V1[name](v1)
        count = next(c for c in table.columns if c in ("total_trips", "trips_per_hour", "pickups_count", "payment_count"))
        assert table.agg(F.sum(count)).first()[0] == n
    revenue = catalog.REPORTS_V1["viz_daily_revenue"](v1)
    assert revenue.where("card_revenue + cash_revenue > total_revenue + 1e-6").count() == 0
    shares = catalog.payment_share(v1).agg(F.sum("share")).first()[0]
    assert shares == pytest.approx(1)


def test_plans_of_core_reports(spark, small):
    v2 = registered.Tables(spark, small).v2()

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    top = plan(catalog.REPORTS_V2["revenue_by_location"](v2))
    assert "TakeOrderedAndProject" in top
    for report in (*catalog.REPORTS_V2.values(), *catalog.COMPOSED_V2.values()):
        text = plan(report(v2))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    narrow = plan(catalog.REPORTS_V2["chart_hourly_trips"](v2))
    assert "l_extendedprice" not in narrow and "l_suppkey" not in narrow



def test_stream_appends_each_file_once(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(source)
    first = make_trips(at(1), at(2), {"trip_distance": 0.0})
    one_file(first, source, "yellow_2023-03.parquet")
    for _ in range(2):
        landing.stream_land_files(spark, source, first.schema, out, log).awaitTermination()
        assert spark.read.parquet(out).count() == 2
    one_file(make_trips(at(3, month=4)), source, "yellow_2023-04.parquet")
    landing.stream_land_files(spark, source, first.schema, out, log).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_stream_replaces_a_month_delivered_again(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(source)
    march = make_trips(at(1), at(2), at(28, month=2))
    one_file(march, source, "yellow_2023-03.parquet")
    one_file(make_trips(at(1, month=2)), source, "yellow_2023-02.parquet")

    def run():
        landing.stream_replace_months(spark, source, march.schema, out, log).awaitTermination()
        rows = spark.read.parquet(out).groupBy("file_month").count().collect()
        return {r.file_month: r["count"] for r in rows}

    assert run() == {2: 1, 3: 3}
    one_file(make_trips(at(1), at(27, month=2)), source, "yellow_2023-03_20230401.parquet")
    assert run() == {2: 1, 3: 2}


def test_two_deliveries_in_one_batch_keep_the_later(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(source)
    earlier = one_file(make_trips(at(1), at(2)), source, "yellow_2023-03.parquet")
    os.utime(earlier, (time.time() - 3600,) * 2)
    later = make_trips(at(5))
    one_file(later, source, "yellow_2023-03_20230401.parquet")
    landing.stream_replace_months(spark, source, later.schema, out, log).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_files_of_one_delivery_are_kept_together(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(f"{source}/file_year=2023/file_month=02")
    march = make_trips(at(1), at(2))
    one_file(march, source, "yellow_2023-03_a.parquet")
    one_file(make_trips(at(3)), source, "yellow_2023-03_b.parquet")
    one_file(make_trips(at(4)), source, "part-00007-31ee.parquet")
    for name in ("part-00000-12ab.parquet", "part-00001-12ab.parquet"):
        one_file(make_trips(at(1, month=2)), f"{source}/file_year=2023/file_month=02", name)
    landing.stream_replace_months(spark, source, march.schema, out, log).awaitTermination()
    counts = {r.file_month: r["count"] for r in spark.read.parquet(out).groupBy("file_month").count().collect()}
    assert counts == {2: 2, 3: 3}
    assert spark.read.parquet(f"{out}-rejected").count() == 1


def test_deliveries_over_several_triggers(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(source)
    march = make_trips(at(1), at(2))

    def run(trips, name):
        one_file(trips, source, name)
        landing.stream_replace_months(spark, source, march.schema, out, log).awaitTermination()
        rows = spark.read.parquet(out).groupBy("file_month").count().collect()
        return {r.file_month: r["count"] for r in rows}

    assert run(make_trips(at(1, month=2)), "yellow_2023-02_20230301.parquet") == {2: 1}
    assert run(march, "a_2023-03_20230401.parquet") == {2: 1, 3: 2}
    assert run(make_trips(at(3)), "b_2023-03_20230401.parquet") == {2: 1, 3: 3}  # more of the same delivery
    assert run(make_trips(at(4)), "yellow_2023-03_20230315.parquet") == {2: 1, 3: 3}  # an older one, late
    assert run(make_trips({"trip_distance": 0.0}), "yellow_2023-03_20230501.parquet") == {2: 1}  # cleaned to nothing
    assert run(make_trips(at(5)), "yellow_2023-03_20230415.parquet") == {2: 1}  # older than the empty one
    assert run(make_trips(at(6)), "yellow_2023-03_20230601.parquet") == {2: 1, 3: 1}


def test_analytics_table_starts_empty_again(spark, tmp_path):
    rows = spark.createDataFrame([], schemas.ANALYTICS_TRIP)
    one = rows.unionByName(spark.sql("SELECT DATE'2023-03-01' AS pickup_date"), allowMissingColumns=True)
    for _ in range(2):
        writers.create_analytics_table(spark, "twice_analytics", str(tmp_path / "analytics"))
        writers.append_analytics(one, "twice_analytics")
        assert spark.table("twice_analytics").count() == 1
    spark.sql("DROP TABLE twice_analytics")


def test_sql_scripts_split_outside_quotes_and_comments():
    script = "SELECT ';' AS a; -- not; here\nSELECT 2 /* nor; here */; SELECT `x;y` FROM t"
    assert [s.split()[0] for s in writers.split_sql(script)] == ["SELECT"] * 3


def test_stream_counts_drop_late_rows(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(source)
    early = make_trips(at(1, 8), at(1, 12))
    one_file(early, source, "a.parquet")

    def run():
        stream = spark.readStream.schema(early.schema).parquet(source)
        windows.write_counts(windows.hourly_counts(stream), out, log, "append").awaitTermination()
        return {r.hour_start.hour: r.trips_per_hour for r in spark.read.parquet(out).collect()}

    assert run() == {8: 1}
    one_file(make_trips(at(1, 8), at(1, 15)), source, "b.parquet")
    assert run() == {8: 1, 12: 1}


def test_late_and_repeated_rows_are_counted(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(source)
    schema = make_trips(at(1)).schema
    ids = lambda frame, *names: frame.withColumn("trip_id", F.element_at(F.array(*map(F.lit, names)), F.col("trip_id").cast("int") + 1))

    def run(frame, name):
        one_file(frame, source, name)
        stream = spark.readStream.schema(schema).parquet(source)
        query = windows.write_counts(windows.hourly_counts(stream, distinct=["trip_id"]), out, log, "append")
        query.awaitTermination()
        return {r.hour_start.hour: r.trips_per_hour for r in spark.read.parquet(out).collect()}, windows.dropped_rows(query)

    hours, dropped = run(ids(make_trips(at(1, 8), at(1, 8), at(1, 12)), "a", "a", "b"), "1.parquet")
    assert hours == {8: 1} and dropped == {"input_rows": 3, "late_rows": 0, "repeated_rows": 1}
    hours, dropped = run(ids(make_trips(at(1, 12), at(1, 13), at(1, 9)), "b", "c", "late"), "2.parquet")
    assert hours == {8: 1} and dropped == {"input_rows": 3, "late_rows": 1, "repeated_rows": 1}
    hours, dropped = run(ids(make_trips(at(1, 18)), "d"), "3.parquet")
    assert hours == {8: 1, 12: 1, 13: 1} and dropped["late_rows"] == 0


def test_backlog_lands_in_batches(spark, make_trips, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.makedirs(source)
    for day in range(1, 7):
        one_file(make_trips(at(day), at(day, month=4), {**at(day), "trip_distance": 0.0}), source, f"{day}.parquet")
    schema = spark.read.parquet(source).schema
    landing.stream_land_batches(spark, source, schema, out, log, max_bytes=1).awaitTermination()
    tables = publish.Publication(spark, out)
    parts = lambda: tables.live().where("folder IS NOT NULL").count()
    rows = lambda: sorted(tuple(r) for r in tables.read("trips").groupBy("pickup_month").count().collect())
    assert rows() == [(3, 6), (4, 6)] and parts() == 12  # six batches of one file
    last = processing.derive_v1(spark.read.parquet(f"{source}/6.parquet"))
    assert landing.land_batch(last, 5, out) == 2  # the last batch again, as after a failure
    assert rows() == [(3, 6), (4, 6)] and parts() == 12
    assert landing.compact_batches(spark, out) == 2
    assert rows() == [(3, 6), (4, 6)] and parts() == 4  # one part a month, and the newest batch
    assert landing.compact_batches(spark, out) == 0
    one_file(make_trips(at(9)), source, "9.parquet")
    landing.stream_land_batches(spark, source, schema, out, log, max_bytes=1).awaitTermination()
    assert rows() == [(3, 7), (4, 6)]


def test_rollup_reads_changed_parts_only(spark, make_trips, tmp_path):
    tables = publish.Publication(spark, str(tmp_path / "p"))

    def deliver(run, *rows):
        trips = processing.month_literals(features.add_features(make_trips(*rows), profiles.V1), 2023, 1).withColumn("file_month", F.month("pickup_date"))
        staged = tables.stage(trips, "trips", run, processing.FILE_MONTH)
        tables.publish([staged], [])
        parts = zones.refresh_daily_rollup(tables, "trips", processing.FILE_MONTH)
        full = zones.daily_location_rollup(tables.read("trips"))
        stored = zones.stored_daily_rollup(tables)
        assert stored.exceptAll(full).count() == full.exceptAll(stored).count() == 0
        return parts

    part = "file_year=2023/file_month={}".format
    assert sorted(deliver("a", at(1), at(1), at(2, month=4))) == [part(3), part(4)]
    assert deliver("b", {**at(5), "fare_amount": None}) == [part(3)]
    assert zones.refresh_daily_rollup(tables, "trips", processing.FILE_MONTH) == []


def test_run_row_has_rates(spark):
    row = quality.run_row(spark, {"run_id": "a", "seconds": 1.5, "rows_read": 4, "record_count": 3}).first()
    assert (row.run_id, row.success_rate, row.rows_read) == ("a", 0.75, 4) and row.recorded_at is not None


def test_stream_equals_batch(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(small)
    counts = windows.hourly_counts(stream, "ts", value="value")
    windows.write_counts(counts, str(tmp_path / "o"), str(tmp_path / "l")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "o")).select("hour_start", "trips_per_hour")
    batch = windows.hourly_counts(events, "ts", value="value").select("hour_start", "trips_per_hour")
    assert stored.exceptAll(batch).count() == 0 and stored.count() == batch.count()


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root) and shared_dir(spark, "x") != shared_dir(spark, "x")


class Unset:
    """A session without a shared folder."""

    def __init__(self, master: str):
        self.conf, self.sparkContext = self, self
        self.master = master

    def get(self, key, default):
        return default


def test_only_local_sessions_use_a_machine_folder():
    first, second = (shared_dir(Unset("local[2]"), "x") for _ in range(2))
    assert os.path.dirname(first) == os.path.dirname(second)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Unset("spark://host:7077"), "x")


def test_union_fills_missing_columns(spark):
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    right = spark.createDataFrame([(2,)], "x int")
    assert sorted(tuple(r) for r in tables.union_tables([left, right]).collect()) == [(1, "a"), (2, None)]


def test_query_parameters(spark, make_trips):
    df = tables.run_query(
        spark, "SELECT count(*) AS n FROM {trips} WHERE passenger_count = :riders", {"riders": 1}, trips=make_trips({})
    )
    assert df.first().n == 1


def test_hourly_counts_query_counts_every_event(spark, tmp_path):
    """Late rows, open hours and rows without a time are counted as well."""
    times = [datetime(2024, 1, 1, 0, 5), datetime(2024, 1, 1, 0, 50), datetime(2024, 1, 9, 7, 0), datetime(2024, 1, 31, 23, 59), None]
    events = spark.createDataFrame([(7 + 50 * i, when, float(i)) for i, when in enumerate(times)], "event_id bigint, ts timestamp_ntz, value double")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = {r.hour_start: (r.trips_per_hour, r.avg_fare_per_hour) for r in registered.queries()["stream_hourly_counts"](spark, str(tmp_path)).collect()}
    assert found == {times[0].replace(minute=0): (2, 0.5), times[2]: (1, 2.0), datetime(2024, 1, 31, 23): (1, 3.0), None: (1, 4.0)}


def test_reports_with_different_keys_share_no_cells(spark, make_trips):
    """Hours, locations and payments are counted apart; a day's metrics come from its hours, the whole from the fewest keys."""
    groups = [list(group) for group in bundles.nested(processing.metric_reports())]
    assert sorted(map(sorted, groups)) == [["daily_metrics", "hourly_metrics"], ["location_metrics"], ["payment_metrics"]]
    assert [list(group) for group in bundles.nested(processing.statistic_reports())] == [["popular_routes"], ["by_borough", "overall"], ["by_time"]]
    rows = [at(1, hour) | {"pu_location_id": place, "payment_type": kind, "fare_amount": 1.0 + hour} for hour in (3, 9) for place in (1, 2, None) for kind in (1, 2)]
    trips = processing.derive_v1(make_trips(*rows))
    reports = processing.metric_reports()
    for name, ours in processing.trip_metrics(trips).items():
        plan = ours._jdf.queryExecution().optimizedPlan().toString()
        above = plan[: plan.index("Relation")]
        assert name != "location_metrics" or ("pickup_date" not in above and "payment_type_desc" not in above)
        as_rows = lambda df: sorted(map(repr, registered.rounded(df).collect()))
        assert as_rows(ours) == as_rows(reports[name](trips)), name
