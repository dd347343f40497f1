"""Independent SQL for the registered queries, in DuckDB's dialect."""

from __future__ import annotations

_BASE = """
line_trips AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_id,
    l_orderkey AS k,
    o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 613) % 86400) AS p,
    o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 613) % 86400
      + CAST(l_quantity AS BIGINT) * 60 + l_partkey * 7 % 60) AS d,
    l_linenumber AS riders,
    ((l_partkey * 13 + l_linenumber * 101) % 2500) / 100 AS miles,
    CAST(l_suppkey + 1 AS INTEGER) AS pu_location_id,
    CAST(l_partkey % 97 + 1 AS INTEGER) AS do_location_id,
    CAST(l_orderkey % 5 + 1 AS INTEGER) AS payment_type,
    l_extendedprice / 1000 AS fare_amount,
    l_extendedprice / 1000 * l_discount AS tip_amount,
    l_extendedprice / 1000 + l_extendedprice / 1000 * l_discount AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
raw AS (
  SELECT trip_id,
    CASE WHEN k % 83 = 0 THEN d ELSE p END AS tpep_pickup_datetime,
    CASE WHEN k % 83 = 0 THEN p ELSE d END AS tpep_dropoff_datetime,
    CASE WHEN k % 97 <> 0 THEN riders END AS passenger_count,
    CASE WHEN k % 89 <> 0 THEN miles END AS trip_distance,
    pu_location_id, do_location_id, payment_type, fare_amount, tip_amount, total_amount
  FROM line_trips
),
zones AS (
  SELECT CAST(s_suppkey + 1 AS INTEGER) AS LocationID, r_name AS Borough, s_name AS Zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
cleaned AS (
  SELECT * FROM raw
  WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND trip_distance > 0 AND trip_distance < 100 AND fare_amount > 0 AND total_amount > 0
    AND passenger_count > 0 AND passenger_count < 10
),
timed1 AS (
  SELECT *, CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
    half_up((epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60, 2) AS trip_duration_minutes
  FROM cleaned
),
v1 AS (
  SELECT *, CAST(pickup_dayofweek IN (1, 7) AS INTEGER) AS is_weekend,
    CASE WHEN pickup_hour BETWEEN 6 AND 10 THEN 'morning_rush' WHEN pickup_hour BETWEEN 11 AND 16 THEN 'midday'
      WHEN pickup_hour BETWEEN 17 AND 20 THEN 'evening_rush' WHEN pickup_hour >= 21 THEN 'night'
      ELSE 'late_night' END AS time_of_day,
    CASE WHEN trip_duration_minutes > 0
      THEN half_up(trip_distance / (trip_duration_minutes / 60), 2) ELSE 0 END AS speed_mph,
    CASE WHEN trip_distance <= 2 THEN 'short' WHEN trip_distance <= 5 THEN 'medium'
      WHEN trip_distance <= 10 THEN 'long' ELSE 'very_long' END AS distance_category,
    CAST(trip_distance > 10 AS INTEGER) AS is_long_trip,
    CASE WHEN trip_distance > 0 THEN half_up(total_amount / trip_distance, 2) ELSE 0 END AS cost_per_mile,
    CASE WHEN trip_duration_minutes > 0
      THEN half_up(total_amount / trip_duration_minutes, 2) ELSE 0 END AS cost_per_minute,
    CASE WHEN fare_amount > 0 THEN half_up(tip_amount / fare_amount * 100, 2) ELSE 0 END AS tip_percentage,
    CASE payment_type WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge'
      WHEN 4 THEN 'dispute' ELSE 'unknown' END AS payment_type_desc
  FROM timed1
),
timed2 AS (
  SELECT trip_id, tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
    passenger_count, trip_distance, pu_location_id AS pickup_location_id, do_location_id AS dropoff_location_id,
    CAST(payment_type AS VARCHAR) AS payment_type, fare_amount, tip_amount, total_amount,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
    (epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60 AS exact_minutes
  FROM raw
),
labelled2 AS (
  SELECT *, pickup_dayofweek IN (1, 7) AS is_weekend,
    CASE WHEN pickup_hour <= 6 THEN 'early_morning' WHEN pickup_hour <= 10 THEN 'morning_rush'
      WHEN pickup_hour <= 15 THEN 'midday' WHEN pickup_hour <= 19 THEN 'evening_rush' ELSE 'night' END AS time_of_day,
    CASE WHEN trip_distance <= 2 THEN 'short' WHEN trip_distance <= 5 THEN 'medium'
      WHEN trip_distance <= 10 THEN 'long' WHEN trip_distance > 10 THEN 'very_long' END AS trip_distance_category,
    half_up(exact_minutes, 2) AS trip_duration_minutes
  FROM timed2
),
v2 AS (
  SELECT * EXCLUDE (exact_minutes), time_of_day IN ('morning_rush', 'evening_rush') AS is_rush_hour,
    CASE WHEN trip_duration_minutes <> 0
      THEN half_up(trip_distance / (trip_duration_minutes / 60), 2) END AS speed_mph,
    CASE WHEN trip_distance > 0 THEN half_up(total_amount / trip_distance, 2) END AS cost_per_mile,
    CASE WHEN trip_duration_minutes <> 0 THEN half_up(total_amount / trip_duration_minutes, 2) END AS cost_per_minute,
    CASE WHEN fare_amount <> 0 THEN half_up(tip_amount / fare_amount * 100, 2) END AS tip_percentage
  FROM labelled2
),
limits AS (
  SELECT quantile_cont(trip_distance, 0.99) AS max_miles, quantile_cont(total_amount, 0.99) AS max_total FROM raw
),
trimmed AS (
  SELECT * FROM raw
  WHERE trip_distance >= 0 AND fare_amount >= 0 AND total_amount >= 0 AND passenger_count > 0
    AND trip_distance < (SELECT max_miles FROM limits) AND total_amount < (SELECT max_total FROM limits)
    AND tpep_dropoff_datetime > tpep_pickup_datetime
)
"""

_ENRICHED = """,
{name} AS (
  SELECT t.*, a.Borough AS pickup_borough, a.Zone AS pickup_zone, b.Borough AS dropoff_borough,
    b.Zone AS dropoff_zone, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    dayofweek(tpep_pickup_datetime) IN (0, 6) AS is_weekend,
    half_up((epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60, 2) AS trip_duration_minutes,
    CASE WHEN hour(tpep_pickup_datetime) BETWEEN 6 AND 10 THEN 'Morning Rush'
      WHEN hour(tpep_pickup_datetime) BETWEEN 11 AND 16 THEN 'Midday'
      WHEN hour(tpep_pickup_datetime) BETWEEN 17 AND 20 THEN 'Evening Rush' ELSE 'Night' END AS time_of_day
  FROM {source} t JOIN zones a ON pu_location_id = a.LocationID JOIN zones b ON do_location_id = b.LocationID
)"""

_SAMPLE = """,
digests AS (
  SELECT o_orderkey, md5(concat_ws('/', '42', '0', o_orderkey)) AS a, md5(concat_ws('/', '42', '1', o_orderkey)) AS b,
    md5(concat_ws('/', '42', '2', o_orderkey)) AS c FROM orders
),
draws AS (
  SELECT list_transform(range(0, 12), lambda i: CAST('0x' || substr(
    CASE i // 4 WHEN 0 THEN a WHEN 1 THEN b ELSE c END, CAST(i % 4 * 8 + 1 AS INTEGER), 8) AS BIGINT)) AS r FROM digests
),
drawn AS (
  SELECT TIMESTAMP '2023-01-01' + to_hours(r[1] % 720) AS pickup_datetime, CAST(r[2] % 115 + 5 AS INTEGER) AS minutes,
    CAST(r[3] % 263 + 1 AS INTEGER) AS pickup_location_id, CAST(r[4] % 263 + 1 AS INTEGER) AS dropoff_location_id,
    CAST(r[5] % 6 + 1 AS INTEGER) AS passenger_count,
    0.5::DOUBLE + (r[6] % 1000000) / 1000000::DOUBLE * 29.5::DOUBLE AS trip_distance,
    2.5::DOUBLE + (r[7] % 1000000) / 1000000::DOUBLE * 97.5::DOUBLE AS fare_amount,
    (r[8] % 1000000) / 1000000::DOUBLE * 20::DOUBLE AS tip_amount,
    (['CREDIT', 'CASH', 'MOBILE'])[r[9] % 3 + 1] AS payment_type,
    (['STREET_HAIL', 'DISPATCH'])[r[10] % 2 + 1] AS trip_type FROM draws
),
sample AS (
  SELECT pickup_datetime, pickup_datetime + to_minutes(minutes) AS dropoff_datetime, pickup_location_id,
    dropoff_location_id, passenger_count, trip_distance, fare_amount, tip_amount,
    fare_amount + tip_amount AS total_amount, payment_type, trip_type,
    tip_amount / fare_amount * 100 AS tip_percentage, (fare_amount + tip_amount) / trip_distance AS cost_per_mile,
    CAST(minutes AS DOUBLE) AS trip_duration_minutes, trip_distance / (minutes / 60) AS speed_mph,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, dayname(pickup_datetime) AS pickup_dayofweek,
    dayofweek(pickup_datetime) IN (0, 6) AS is_weekend,
    CASE WHEN hour(pickup_datetime) <= 6 THEN 'NIGHT' WHEN hour(pickup_datetime) <= 12 THEN 'MORNING'
      WHEN hour(pickup_datetime) <= 18 THEN 'AFTERNOON' ELSE 'EVENING' END AS time_of_day,
    CASE WHEN trip_distance <= 2 THEN 'SHORT' WHEN trip_distance <= 5 THEN 'MEDIUM'
      WHEN trip_distance <= 10 THEN 'LONG' ELSE 'VERY_LONG' END AS trip_distance_category FROM drawn
)"""

_MONTHLY = """,
monthly AS (
  SELECT make_date(pickup_year, pickup_month, 1) AS month, count(*) AS total_trips,
    tidy(sum(total_amount), 2) AS total_revenue, tidy(avg(total_amount), 2) AS avg_fare,
    tidy(avg(trip_distance), 2) AS avg_distance, tidy(avg(trip_duration_minutes), 2) AS avg_duration,
    tidy(avg(tip_percentage), 2) AS avg_tip_percent
  FROM v2 GROUP BY ALL
)"""

_V4 = _ENRICHED.format(name="v4", source="trimmed")

# Two-sided Student p by Simpson's rule on the density from 0 to |t|.
_T_P = """(1 - 2 * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi()) * abs({t}) / 6000 *
  list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
    * pow(1 + pow({t} * i / 2000, 2) / {df}, -({df} + 1) / 2))))"""


def _with(select: str, extra: str = "") -> str:
    return f"WITH {_BASE.strip()}{extra}\n{select}"


# Roundings spelled out below: ``tidy(x, d)`` rounds an aggregate half up after
# dropping the noise of its last bits; ``half_up(x, d)`` rounds the shortest
# decimal text of a double half up.
_ROUNDINGS = {
    "tidy": "CAST(round(CAST({value} AS DECIMAL(38, 9)),{digits}) AS DOUBLE)",
    "half_up": "CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)),{digits}) AS DOUBLE)",
}


def _expand(sql: str) -> str:
    for name, form in _ROUNDINGS.items():
        call = f"{name}("
        while (at := sql.rfind(call)) >= 0:
            start = end = at + len(call)
            depth, comma = 0, -1
            while depth >= 0:
                depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(sql[end], 0)
                if sql[end] == "," and depth == 0:
                    comma = end
                end += 1
            text = form.format(value=sql[start:comma], digits=sql[comma + 1 : end - 1])
            sql = sql[:at] + text + sql[end:]
    return sql


def r6(expression: str, name: str, digits: int = 6) -> str:
    return f"tidy({expression}, {digits}) AS {name}"


def _frequency(columns: str, table: str, where: str = "") -> str:
    return _with(f"SELECT {columns}, count(*) AS row_count FROM {table} {where} GROUP BY ALL")


def _grouped(table: str, keys: str, measures: dict[str, str], digits: int = 6, tail: str = "", extra: str = "") -> str:
    """Grouped SQL: ``n`` counts, ``a:x`` averages, ``s:x`` sums, anything else is verbatim."""
    parts = [keys] if keys else []
    for name, text in measures.items():
        if text == "n":
            parts.append(f"count(*) AS {name}")
        elif text[:2] in ("a:", "s:"):
            parts.append(r6(f"{'avg' if text[0] == 'a' else 'sum'}({text[2:]})", name, digits))
        else:
            parts.append(f"{text} AS {name}")
    grouping = "GROUP BY ALL" if keys else ""
    return _with(f"SELECT {', '.join(parts)} FROM {table} {grouping} {tail}", extra)


FARE, MILES, MINUTES = "a:total_amount", "a:trip_distance", "a:trip_duration_minutes"
SPEED, TIP, REVENUE = "a:speed_mph", "a:tip_percentage", "s:total_amount"
WEEKEND_LABEL = "CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type"


def _features() -> dict[str, str]:
    v1 = ("is_long_trip", "payment_type_desc")
    both = ("speed_mph", "cost_per_mile", "cost_per_minute", "tip_percentage", "time_of_day")
    v2 = (
        "pickup_date", "pickup_hour", "pickup_day", "pickup_dayofweek", "trip_duration_minutes",
        "is_weekend", "is_rush_hour", *both,
    )
    return {
        **{name: _frequency(name, "v1") for name in v1},
        **{f"{name}_v1": _frequency(name, "v1") for name in both},
        **{name: _frequency(name, "v2") for name in v2},
        "pickup_month_year": _frequency("pickup_year, pickup_month", "v2"),
        "distance_category": _frequency("trip_distance_category", "v2"),
    }


def _sources() -> dict[str, str]:
    analytics = (
        "trip_id, pickup_datetime, dropoff_datetime, pickup_date, pickup_hour, pickup_day, pickup_month, pickup_year, "
        "pickup_dayofweek, trip_duration_minutes, trip_distance, speed_mph, passenger_count, fare_amount, tip_amount, "
        "total_amount, cost_per_mile, cost_per_minute, tip_percentage, trip_distance_category, time_of_day, "
        "is_weekend, is_rush_hour, payment_type, pickup_location_id, dropoff_location_id"
    )
    may = "WHERE pickup_year = 1996 AND pickup_month = 5"
    return {
        "scan_parquet_inferred": "SELECT * FROM orders",
        "scan_month_glob": _with(f"SELECT trip_id, total_amount FROM v2 {may}"),
        "scan_parquet_schema": _with(
            "SELECT tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, pu_location_id, "
            "do_location_id, payment_type, fare_amount, tip_amount, total_amount FROM raw"
        ),
        "scan_drifting_months": _with(
            "SELECT trip_id, CAST(year(tpep_pickup_datetime) AS INTEGER) AS file_year, "
            "CAST(month(tpep_pickup_datetime) AS INTEGER) AS file_month, trip_distance, pu_location_id, do_location_id, "
            "fare_amount, total_amount, tpep_pickup_datetime, "
            "CASE WHEN year(tpep_pickup_datetime) < 1995 AND passenger_count = 7 THEN NULL ELSE CAST(passenger_count AS DOUBLE) END AS passenger_count, "
            "CASE WHEN year(tpep_pickup_datetime) < 1995 AND payment_type = 5 THEN NULL ELSE CAST(payment_type AS DOUBLE) END AS payment_type, "
            "CASE WHEN year(tpep_pickup_datetime) < 1995 THEN CAST(coalesce(passenger_count = 7, FALSE) AS INTEGER) "
            "+ CAST(payment_type = 5 AS INTEGER) ELSE 0 END AS misfits FROM raw"
        ),
        "scan_zone_csv": _with("SELECT * FROM zones"),
        "scan_table": _frequency("payment_type", "v2"),
        "scan_month_table": _with(
            f"SELECT pickup_date, count(*) AS trip_count, tidy(sum(total_amount), 6) AS revenue FROM v2 {may} GROUP BY ALL"
        ),
        "fetch_month": _with(f"SELECT {analytics} FROM v2 {may}"),
        "scan_wildcard": _with(
            "SELECT payment_type, trip_type, count(*) AS trip_count, tidy(avg(total_amount), 6) AS avg_fare FROM "
            "(SELECT payment_type, NULL::VARCHAR AS trip_type, total_amount FROM v2 UNION ALL "
            "SELECT payment_type, trip_type, total_amount FROM sample) GROUP BY ALL",
            _SAMPLE,
        ),
        "run_query": _with(
            "SELECT pickup_location_id, count(*) AS trip_count FROM v2 GROUP BY ALL"
        ),
        "generate_trips": _with(
            "SELECT * REPLACE (tidy(trip_distance, 6) AS trip_distance, tidy(fare_amount, 6) AS fare_amount, "
            "tidy(tip_amount, 6) AS tip_amount, tidy(total_amount, 6) AS total_amount, "
            "tidy(tip_percentage, 6) AS tip_percentage, tidy(cost_per_mile, 6) AS cost_per_mile, "
            "tidy(trip_duration_minutes, 6) AS trip_duration_minutes, tidy(speed_mph, 6) AS speed_mph) FROM sample",
            _SAMPLE,
        ),
        "month_range": (
            "SELECT CAST(m AS DATE) AS month_start, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month "
            "FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), "
            "date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)"
        ),
        "write_parquet_month": _grouped(
            "v1", "pickup_year, pickup_month", {"trip_count": "n", "revenue": REVENUE}
        ),
        "write_statistics": _grouped(
            "v4",
            "pickup_borough",
            {"trips": "n", "avg_distance": MILES, "avg_fare": FARE, "total_revenue": REVENUE},
            2,
            extra=_V4,
        ),
        "write_metric_table": _grouped(
            "v1", "pickup_year, pickup_month, payment_type_desc", {"payment_count": "n", "total_revenue": REVENUE, "avg_tip_percentage": TIP}
        ),
        "write_trips_partitioned": _frequency("pickup_date, pickup_hour", "v1"),
        "append_analytics": _with(
            "SELECT payment_type, time_of_day, is_weekend, count(*) AS trip_count, tidy(avg(total_amount), 6) AS avg_fare, "
            "tidy(avg(tip_percentage), 6) AS avg_tip_percentage, tidy(avg(cost_per_mile), 6) AS avg_cost_per_mile "
            "FROM v2 GROUP BY ALL"
        ),
        "write_hash_distributed": _frequency("pickup_location_id", "v2"),
        "save_query_result": _grouped(
            "v2", "pickup_location_id", {"trip_count": "n", "avg_fare": "a:fare_amount"}
        ),
        "run_sql_script": _frequency("pickup_hour", "v2"),
        "truncate_load": _with("SELECT pickup_dayofweek, count(*) AS row_count FROM sample GROUP BY ALL", _SAMPLE),
    }


def _cleaning() -> dict[str, str]:
    metrics = ("total_amount", "trip_distance", "trip_duration_minutes", "speed_mph")
    outside = " UNION ALL ".join(
        f"SELECT trip_id, '{m}' AS metric, {m} AS value FROM v2, (SELECT quantile_cont({m}, 0.25) AS q1, "
        f"quantile_cont({m}, 0.75) AS q3 FROM v2) WHERE {m} < q1 - 1.5 * (q3 - q1) OR {m} > q3 + 1.5 * (q3 - q1)"
        for m in metrics
    )
    rejects = {
        "tpep_pickup_datetime_missing": "tpep_pickup_datetime IS NOT NULL",
        "tpep_dropoff_datetime_missing": "tpep_dropoff_datetime IS NOT NULL",
        "trip_distance_missing": "trip_distance IS NOT NULL",
        "fare_amount_missing": "fare_amount IS NOT NULL",
        "total_amount_missing": "total_amount IS NOT NULL",
        "distance_out_of_range": "trip_distance > 0 AND trip_distance < 100",
        "fare_not_positive": "fare_amount > 0",
        "total_not_positive": "total_amount > 0",
        "passengers_out_of_range": "passenger_count > 0 AND passenger_count < 10",
    }
    reasons = " UNION ALL ".join(
        f"SELECT '{name}' AS reason, count(*) AS rejected_rows FROM raw WHERE NOT coalesce({rule}, FALSE)"
        for name, rule in rejects.items()
    )
    valid = " AND ".join(f"({rule})" for rule in rejects.values())
    counts = (
        "count(*) AS record_count, count(*) FILTER (pickup_datetime IS NULL) AS null_pickup_count, "
        "count(*) FILTER (dropoff_datetime IS NULL) AS null_dropoff_count, "
        "count(*) FILTER (fare_amount < 0) AS negative_fare_count"
    )
    zero = " UNION ALL ".join(
        f"SELECT '{c}' AS check_name, CAST({c} AS DOUBLE) AS observed, {c} = 0 AS passed FROM c"
        for c in ("null_pickup_count", "null_dropoff_count", "negative_fare_count")
    )
    counted = f",\nc AS (SELECT {counts} FROM v2)"
    return {
        "drop_null_critical": _with(
            "SELECT trip_id FROM raw WHERE trip_distance IS NOT NULL AND fare_amount IS NOT NULL "
            "AND total_amount IS NOT NULL AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"
        ),
        "clean_trips": _with(
            "SELECT trip_id, trip_distance, fare_amount, total_amount, passenger_count FROM cleaned"
        ),
        "clean_trips_p99": _with("SELECT trip_id FROM trimmed"),
        "between_hour": _frequency("pickup_hour, pickup_location_id", "v2", "WHERE pickup_hour BETWEEN 6 AND 10"),
        "in_list": _frequency("payment_type_desc", "v1", "WHERE payment_type IN (1, 2)"),
        "split_weekday_weekend": _with(
            "SELECT time_of_day, count(*) FILTER (NOT is_weekend) AS weekday_trips, "
            "tidy(sum(total_amount) FILTER (NOT is_weekend), 6) AS weekday_revenue, "
            "count(*) FILTER (is_weekend) AS weekend_trips, "
            "tidy(sum(total_amount) FILTER (is_weekend), 6) AS weekend_revenue FROM v2 GROUP BY ALL"
        ),
        "iqr_outliers": _with(outside),
        "iqr_outlier_counts": _with(f"SELECT metric, count(*) AS anomaly_count FROM ({outside}) GROUP BY ALL"),
        "recent_window_filter": _frequency(
            "pickup_date", "v2", "WHERE pickup_date >= (SELECT max(pickup_date) FROM v2) - 30"
        ),
        "value_semi_join": _with(
            "SELECT trip_id, tidy(speed_mph, 6) AS speed_mph FROM v2, (SELECT quantile_cont(speed_mph, 0.25) AS q1, "
            "quantile_cont(speed_mph, 0.75) AS q3 FROM v2) "
            "WHERE speed_mph < q1 - 1.5 * (q3 - q1) OR speed_mph > q3 + 1.5 * (q3 - q1)"
        ),
        "dq_counts": _with("SELECT * FROM c", counted),
        "dq_assertions": _with(zero, counted),
        "record_count_bounds": _with(
            "SELECT 'min_records' AS check_name, CAST(record_count AS DOUBLE) AS observed, record_count >= 1000 AS passed "
            "FROM c UNION ALL SELECT 'max_records', CAST(record_count AS DOUBLE), record_count <= 10000000 FROM c",
            counted,
        ),
        "success_rate": _with(
            f"SELECT count(*) AS input_rows, count(*) FILTER ({valid}) AS valid_rows, "
            f"tidy(count(*) FILTER ({valid}) / count(*), 6) AS success_rate, "
            f"count(*) FILTER ({valid}) / count(*) >= 0.95 AS passed FROM raw"
        ),
        "min_count_check": _with("SELECT count(*) >= 1000 AS passed FROM v2"),
        "flow_run_metrics": _with(
            "SELECT 'trips' AS table_name, CAST(1 AS BIGINT) AS version, "
            "(SELECT count(DISTINCT (year(tpep_pickup_datetime), month(tpep_pickup_datetime))) FROM raw) AS months, "
            "(SELECT count(*) FROM raw) AS rows_read, count(*) AS record_count, "
            "count(*) FILTER (tpep_pickup_datetime IS NULL) AS null_pickup_count, "
            "count(*) FILTER (tpep_dropoff_datetime IS NULL) AS null_dropoff_count, "
            "count(*) FILTER (fare_amount < 0) AS negative_fare_count FROM v1"
        ),
        "run_metrics": _with("SELECT *, 'run' AS run_id, 'analytics' AS flow FROM c", counted),
        "reject_reasons": _with(f"SELECT * FROM ({reasons}) WHERE rejected_rows > 0"),
    }


def _derived() -> dict[str, str]:
    v1_columns = (
        "trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, pu_location_id, "
        "do_location_id, payment_type, fare_amount, tip_amount, total_amount, pickup_date, pickup_hour, pickup_day, "
        "pickup_month, pickup_year, pickup_dayofweek, trip_duration_minutes, is_weekend, time_of_day, speed_mph, "
        "distance_category, is_long_trip, cost_per_mile, cost_per_minute, tip_percentage, payment_type_desc"
    )
    return {
        **_features(),
        "parse_timestamps": _with(
            "SELECT trip_id, CASE WHEN payment_type <> 5 THEN tpep_pickup_datetime END AS pickup_datetime, "
            "tpep_dropoff_datetime AS dropoff_datetime FROM raw"
        ),
        "pickup_dayname": _frequency("dayname(pickup_datetime) AS day_name", "v2"),
        "time_of_day_profiles": _with(
            "SELECT pickup_hour, CASE WHEN pickup_hour <= 5 THEN 'late_night' WHEN pickup_hour <= 10 THEN 'morning_rush' "
            "WHEN pickup_hour <= 16 THEN 'midday' WHEN pickup_hour <= 20 THEN 'evening_rush' ELSE 'night' END AS five_v1, "
            "time_of_day AS five_v2, CASE WHEN pickup_hour <= 5 THEN 'Night' WHEN pickup_hour <= 10 THEN 'Morning Rush' "
            "WHEN pickup_hour <= 16 THEN 'Midday' WHEN pickup_hour <= 20 THEN 'Evening Rush' ELSE 'Night' END AS four_v4, "
            "CASE WHEN pickup_hour <= 6 THEN 'NIGHT' WHEN pickup_hour <= 12 THEN 'MORNING' "
            "WHEN pickup_hour <= 18 THEN 'AFTERNOON' ELSE 'EVENING' END AS four_v5, count(*) AS row_count "
            "FROM v2 GROUP BY ALL"
        ),
        "bin_cut": _frequency(
            "trip_distance, CASE WHEN trip_distance <= 0 THEN NULL WHEN trip_distance <= 2 THEN 'SHORT' "
            "WHEN trip_distance <= 5 THEN 'MEDIUM' WHEN trip_distance <= 10 THEN 'LONG' "
            "WHEN trip_distance > 10 THEN 'VERY_LONG' END AS label",
            "raw",
        ),
        "features_v1": _with(f"SELECT {v1_columns} FROM v1"),
        "features_v2": _with("SELECT * FROM v2"),
        "features_local": _with(
            "SELECT * EXCLUDE (exact_minutes) REPLACE (tidy(exact_minutes, 6) AS trip_duration_minutes, "
            "tidy(fare_amount, 6) AS fare_amount, tidy(tip_amount, 6) AS tip_amount, "
            "tidy(total_amount, 6) AS total_amount, "
            "CASE WHEN trip_distance > 0 THEN trip_distance_category END AS trip_distance_category), "
            "time_of_day IN ('morning_rush', 'evening_rush') AS is_rush_hour, "
            "CASE WHEN exact_minutes <> 0 THEN tidy(trip_distance / (exact_minutes / 60), 6) END AS speed_mph, "
            "CASE WHEN trip_distance <> 0 THEN tidy(total_amount / trip_distance, 6) END AS cost_per_mile, "
            "CASE WHEN exact_minutes <> 0 THEN tidy(total_amount / exact_minutes, 6) END AS cost_per_minute, "
            "CASE WHEN fare_amount <> 0 THEN tidy(tip_amount / fare_amount * 100, 6) END AS tip_percentage FROM labelled2"
        ),
        "day_type": _frequency(WEEKEND_LABEL, "v2"),
        "demand_level": _with(
            "SELECT pickup_location_id, trip_count, CASE WHEN trip_count > m + s THEN 'High' "
            "WHEN trip_count < m - s THEN 'Low' ELSE 'Normal' END AS demand_level "
            "FROM (SELECT *, avg(trip_count) OVER () AS m, stddev_samp(trip_count) OVER () AS s FROM "
            "(SELECT pickup_location_id, count(*) AS trip_count FROM v2 GROUP BY ALL))"
        ),
        "month_start": _frequency("make_date(pickup_year, pickup_month, 1) AS month_start", "v2"),
        "date_hour_extract": _frequency(
            "CAST(pickup_datetime AS DATE) AS date, CAST(hour(pickup_datetime) AS INTEGER) AS hour", "v2"
        ),
        "landing_path": _with(
            "SELECT printf('raw/%d/%02d/yellow_tripdata_%d-%02d.parquet', pickup_year, pickup_month, pickup_year, "
            "pickup_month) AS path, printf('yellow_tripdata_%d-%02d_%d%02d01.parquet', pickup_year, pickup_month, "
            "pickup_year, pickup_month) AS dated_name, row_count FROM "
            "(SELECT pickup_year, pickup_month, count(*) AS row_count FROM v2 GROUP BY ALL)"
        ),
    }


def _zone_joins() -> dict[str, str]:
    enriched = _ENRICHED.format(name="enriched", source="raw")
    return {
        "zone_enrich": _with(
            "SELECT trip_id, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone FROM enriched", enriched
        ),
        "zone_enrich_features": _with(
            "SELECT trip_id, pickup_zone, dropoff_zone, trip_duration_minutes, CASE WHEN trip_duration_minutes > 0 "
            "THEN half_up(total_amount / trip_duration_minutes, 2) END AS cost_per_minute, pickup_hour, pickup_day, "
            "pickup_month, is_weekend, time_of_day FROM enriched",
            enriched,
        ),
        "cross_stats": _with(
            "SELECT *, tidy(avg(row_count) OVER (), 6) AS avg_trips, "
            "tidy(stddev_samp(row_count) OVER (), 6) AS stddev_trips FROM "
            "(SELECT pickup_hour, count(*) AS row_count FROM v2 GROUP BY ALL)"
        ),
        "broadcast_zone_rollup": _with(
            "SELECT Zone AS zone_name, count(*) AS trip_count, tidy(sum(total_amount), 6) AS total_revenue, "
            "tidy(avg(total_amount), 6) AS avg_fare FROM raw JOIN zones ON pu_location_id = LocationID GROUP BY ALL"
        ),
        "daily_metrics_zone_join": _with(
            "SELECT pickup_date AS date, Zone AS zone_name, count(*) AS trip_count, tidy(avg(fare_amount), 6) AS avg_fare "
            "FROM v1 JOIN zones ON pu_location_id = LocationID "
            "WHERE pickup_date >= (SELECT max(pickup_date) FROM v1) - 30 GROUP BY pickup_date, LocationID, Zone"
        ),
        "zone_gap_report": _with(
            "SELECT pu_location_id, count(*) AS unmatched_trips FROM raw "
            "WHERE pu_location_id NOT IN (SELECT LocationID FROM zones WHERE LocationID % 10 <> 7) GROUP BY ALL"
        ),
        "incremental_rollup": _with(
            "SELECT pickup_date AS date, pu_location_id, count(*) AS trip_count, tidy(avg(fare_amount), 6) AS avg_fare FROM v1 "
            "WHERE NOT (pickup_year = 1996 AND pickup_month = 5 AND passenger_count < 3) GROUP BY ALL"
        ),
        "daily_location_rollup": _grouped(
            "v1", "pickup_date AS date, pu_location_id", {"trip_count": "n", "avg_fare": "a:fare_amount"}
        ),
    }


def _reports() -> dict[str, str]:
    fmd = {"avg_fare": FARE, "avg_distance": MILES, "avg_duration": MINUTES}
    weekday = {"total_trips": "n", **fmd}
    geographic = {"trip_count": "n", "avg_distance": MILES, "avg_fare": FARE, "avg_speed": SPEED}
    pairs = (
        ",\npairs AS (SELECT pickup_location_id, dropoff_location_id, count(*) AS trip_count, "
        "avg(trip_distance) AS avg_distance, avg(total_amount) AS avg_fare, avg(speed_mph) AS avg_speed "
        "FROM v2 GROUP BY ALL)"
    )
    hours = ", ".join(
        f"CASE WHEN count(*) FILTER (pickup_hour = {h}) > 0 THEN count(*) FILTER (pickup_hour = {h}) END AS h{h}"
        for h in range(24)
    )
    bands = ("early_morning", "morning_rush", "midday", "evening_rush", "night")
    columns = ", ".join(f"count(*) FILTER (time_of_day = '{b}') AS {b}" for b in bands)
    performance = {"trip_count": "n", "avg_speed": SPEED, "avg_duration": MINUTES, "avg_fare": FARE}
    daily = {
        "total_trips": "n", "total_revenue": REVENUE, "avg_distance": MILES, "avg_duration": MINUTES,
        "avg_tip_percentage": TIP,
    }
    borough = {"trips": "n", "avg_distance": MILES, "avg_fare": FARE, "total_revenue": REVENUE}
    counts = ("trips_by_hour", "pickup_hour"), ("trips_by_dayofweek", "pickup_dayofweek"), ("trips_by_weekend", "is_weekend")
    return {
        "daily_metrics": _grouped("v1", "pickup_date", daily),
        "hourly_metrics": _grouped(
            "v1", "pickup_date, pickup_hour", {"trips_per_hour": "n", "avg_fare_per_hour": FARE}
        ),
        "location_metrics": _grouped(
            "v1", "pu_location_id", {"pickups_count": "n", "avg_fare": FARE, "avg_trip_distance": MILES}
        ),
        "payment_metrics": _grouped(
            "v1", "payment_type_desc", {"payment_count": "n", "total_revenue": REVENUE, "avg_tip_percentage": TIP}
        ),
        "viz_hourly_patterns": _grouped("v1", "pickup_hour", weekday),
        "viz_daily_revenue": _grouped(
            "v1",
            "pickup_date",
            {
                "total_trips": "n",
                "total_revenue": REVENUE,
                "avg_tip_percentage": TIP,
                "card_revenue": "s:CASE WHEN payment_type_desc = 'credit_card' THEN total_amount ELSE 0 END",
                "cash_revenue": "s:CASE WHEN payment_type_desc = 'cash' THEN total_amount ELSE 0 END",
            },
        ),
        "viz_distance_distribution": _grouped(
            "v1",
            "distance_category",
            {"trip_count": "n", "avg_fare": FARE, "avg_duration": MINUTES, "avg_tip_percentage": TIP},
        ),
        "viz_payment_analysis": _grouped(
            "v1",
            "payment_type_desc",
            {"trip_count": "n", "avg_fare": FARE, "avg_tip_percentage": TIP, "avg_distance": MILES},
        ),
        "viz_time_performance": _grouped(
            "v1",
            "time_of_day",
            {"total_trips": "n", "avg_fare": FARE, "avg_duration": MINUTES, "avg_speed": SPEED, "avg_tip_percentage": TIP},
        ),
        "viz_weekday_weekend": _grouped(
            "v1", "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type",
            {**weekday, "avg_tip_percentage": TIP},
        ),
        "viz_location_performance": _grouped(
            "v1",
            "pu_location_id",
            {
                "total_pickups": "n",
                "avg_fare": FARE,
                "avg_distance": MILES,
                "avg_tip_percentage": TIP,
                "morning_rush_trips": "count(*) FILTER (time_of_day = 'morning_rush')",
                "evening_rush_trips": "count(*) FILTER (time_of_day = 'evening_rush')",
            },
        ),
        "location_trip_counts": _grouped(
            "v2", "pickup_location_id", {"trip_count": "n", "avg_fare": "a:fare_amount"}
        ),
        "view_trip_volume": _grouped(
            "v2",
            "pickup_hour, pickup_dayofweek, time_of_day",
            {"trip_count": "n", "avg_fare": FARE, "avg_distance": MILES},
        ),
        "view_financial": _grouped("v2", "payment_type, time_of_day, is_weekend", _FINANCIAL),
        "create_view": _grouped("v2", "payment_type, time_of_day, is_weekend", _FINANCIAL),
        "view_geographic": _grouped("v2", "pickup_location_id, dropoff_location_id", geographic),
        "view_performance": _grouped("v2", "trip_distance_category, time_of_day, is_weekend", performance),
        "hourly_demand": _grouped("v2", "pickup_hour", {**weekday, "avg_speed": SPEED}, 2),
        "revenue_by_location": _grouped(
            "v2",
            "pickup_location_id",
            {
                "total_trips": "n",
                "total_revenue": REVENUE,
                "avg_fare": FARE,
                "avg_distance": MILES,
                "avg_tip_percent": TIP,
            },
            2,
            "ORDER BY total_revenue DESC, pickup_location_id LIMIT 10",
        ),
        "payment_patterns": _grouped(
            "v2",
            "payment_type",
            {
                "total_trips": "n",
                "total_revenue": REVENUE,
                "avg_tip_percent": TIP,
                "avg_fare": FARE,
                "weekend_trips": "count(*) FILTER (is_weekend)",
                "rush_hour_trips": "count(*) FILTER (is_rush_hour)",
            },
            2,
        ),
        "trip_distance_analysis": _grouped(
            "v2",
            "trip_distance_category",
            {"total_trips": "n", "avg_fare": FARE, "avg_duration": MINUTES, "avg_speed": SPEED, "avg_tip_percent": TIP},
            2,
        ),
        "weekday_weekend_comparison": _grouped(
            "v2", WEEKEND_LABEL, {**weekday, "avg_tip_percent": TIP, "avg_speed": SPEED}, 2
        ),
        "rush_hour_impact": _grouped(
            "v2",
            "time_of_day",
            {"total_trips": "n", "avg_fare": FARE, "avg_speed": SPEED, "avg_duration": MINUTES, "avg_tip_percent": TIP},
            2,
        ),
        "hour_day_counts": _grouped(
            "v2", "pickup_hour, CAST(dayofweek(pickup_date) + 1 AS INTEGER) AS day_of_week", {"trip_count": "n"}
        ),
        "hourly_fare_spread": _grouped(
            "v2",
            "pickup_hour",
            {"avg_fare": "a:fare_amount", "std_fare": "tidy(stddev_samp(fare_amount), 6)", "trip_count": "n"},
        ),
        "radar_profile": _grouped(
            "v2", "time_of_day", {"avg_speed": SPEED, "avg_fare": FARE, "avg_tip": TIP, "avg_distance": MILES}
        ),
        "location_profile": _grouped(
            "v2",
            "pickup_location_id",
            {"total_trips": "n", "avg_fare": FARE, "avg_distance": MILES, "avg_tip_percent": TIP, "avg_speed": SPEED},
        ),
        "chart_hourly_trips": _grouped(
            "v2", "CAST(hour(pickup_datetime) AS INTEGER) AS hour", {"trip_count": "n"}
        ),
        "chart_revenue_by_payment": _grouped("v2", "payment_type", {"total_revenue": REVENUE}),
        "chart_daily_revenue": _grouped(
            "v2", "CAST(pickup_datetime AS DATE) AS date", {"daily_revenue": REVENUE}
        ),
        **{name: _grouped("v2", key, {"trip_count": "count(trip_id)"}) for name, key in counts},
        "mean_by_time": _grouped(
            "v2", "time_of_day", {"avg_fare": FARE, "avg_tip_percentage": TIP, "avg_speed": SPEED}
        ),
        "overall_stats": _grouped(
            "v4",
            "",
            {
                "total_trips": "n",
                "avg_trip_duration": MINUTES,
                "avg_distance": MILES,
                "avg_fare": FARE,
                "avg_tip": "a:tip_amount",
                "total_revenue": REVENUE,
            },
            2,
            extra=_V4,
        ),
        "borough_stats": _grouped("v4", "pickup_borough", borough, 2, extra=_V4),
        "time_stats": _grouped(
            "v4", "time_of_day", {"trips": "n", "avg_duration": MINUTES, "avg_fare": FARE}, 2, extra=_V4
        ),
        "popular_routes": _grouped(
            "v4",
            "pickup_zone, dropoff_zone",
            {"trip_count": "n", "avg_fare": FARE},
            2,
            "ORDER BY trip_count DESC, pickup_zone, dropoff_zone LIMIT 10",
            _V4,
        ),
        "wildcard_union": _grouped(
            "v2",
            "pickup_hour, pickup_dayofweek, time_of_day",
            {"trip_count": "n", "avg_fare": FARE, "avg_distance": MILES},
        ),
        "stream_land_files": _grouped("v1", "pickup_hour", weekday),
        "stream_replace_months": _grouped("v1", "pickup_hour", weekday),
        "peak_hours": _with(
            "SELECT pickup_hour, trip_count, tidy(f, 6) AS avg_fare, tidy(tip, 6) AS avg_tip_percent, "
            "CASE WHEN trip_count > m + s THEN 'High' WHEN trip_count < m - s THEN 'Low' ELSE 'Normal' END AS demand_level "
            "FROM (SELECT *, avg(trip_count) OVER () AS m, stddev_samp(trip_count) OVER () AS s FROM "
            "(SELECT pickup_hour, count(*) AS trip_count, avg(total_amount) AS f, avg(tip_percentage) AS tip "
            "FROM v2 GROUP BY ALL))"
        ),
        "summary_report": _grouped(
            "v2",
            "",
            {
                "total_trips": "n",
                "total_revenue": REVENUE,
                **fmd,
                "avg_tip_percent": TIP,
                "avg_speed": SPEED,
                "unique_pickup_locations": "count(DISTINCT pickup_location_id)",
                "unique_dropoff_locations": "count(DISTINCT dropoff_location_id)",
            },
            2,
        ),
        "demand_heatmap": _with(
            f"SELECT CAST(dayofweek(pickup_date) + 1 AS INTEGER) AS day_of_week, {hours} FROM v2 GROUP BY ALL"
        ),
        "distance_time_pivot": _with(f"SELECT trip_distance_category, {columns} FROM v2 GROUP BY ALL"),
        "top_pickup_locations": _with(
            "SELECT pickup_location_id, CAST(sum(trip_count) AS BIGINT) AS trip_count, tidy(avg(avg_fare), 6) AS avg_fare, "
            "tidy(sum(avg_fare * trip_count) / sum(trip_count), 6) AS weighted_fare FROM pairs GROUP BY ALL "
            "ORDER BY trip_count DESC, pickup_location_id LIMIT 10",
            pairs,
        ),
        "scatter_speed_distance": _with(
            "SELECT pickup_location_id, dropoff_location_id, tidy(avg_distance, 6) AS avg_distance, "
            "tidy(avg_speed, 6) AS avg_speed, tidy(avg_fare, 6) AS avg_fare FROM pairs",
            pairs,
        ),
        "time_grain_rollup": _with(
            "SELECT CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS period, count(*) AS trip_count FROM v2 "
            "GROUP BY ALL"
        ),
        "payment_share": _with(
            "SELECT payment_type, trip_count, tidy(trip_count / sum(trip_count) OVER (), 6) AS share FROM "
            "(SELECT payment_type, count(*) AS trip_count FROM v2 GROUP BY ALL)"
        ),
        "value_counts": _frequency("trip_distance_category", "v2", "WHERE trip_distance_category IS NOT NULL"),
        "value_counts_top_pickups": _with(
            "SELECT pickup_location_id, count(*) AS row_count FROM v2 GROUP BY ALL "
            "ORDER BY row_count DESC, pickup_location_id LIMIT 10"
        ),
        "order_by_label": _with(
            "SELECT time_of_day, count(*) AS row_count, CAST(CASE time_of_day WHEN 'early_morning' THEN 1 "
            "WHEN 'morning_rush' THEN 2 WHEN 'midday' THEN 3 WHEN 'evening_rush' THEN 4 WHEN 'night' THEN 5 END "
            "AS INTEGER) AS label_rank FROM v2 GROUP BY ALL"
        ),
        "top_n_by": _with(
            "SELECT pickup_location_id, dropoff_location_id, trip_count FROM pairs "
            "ORDER BY trip_count DESC, pickup_location_id, dropoff_location_id LIMIT 25",
            pairs,
        ),
        "limit_rows": _with(
            "SELECT trip_id, trip_distance, trip_duration_minutes, total_amount, time_of_day FROM v2 "
            "ORDER BY md5('0/' || trip_id), trip_id LIMIT 10000"
        ),
        "sample_n": _with(
            "SELECT trip_id, trip_distance, speed_mph, time_of_day FROM v2 ORDER BY md5('42/' || trip_id), trip_id LIMIT 1000"
        ),
        "union_months": _with(
            "SELECT pickup_date, count(*) AS trip_count, tidy(sum(total_amount), 6) AS revenue FROM v2 "
            "GROUP BY ALL"
        ),
        "stream_land_batches": _grouped("v1", "pickup_hour", weekday),
        "stream_hourly_counts": (
            "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, count(*) AS trips_per_hour, "
            "tidy(avg(value), 6) AS avg_fare_per_hour FROM events GROUP BY ALL"
        ),
        "stream_dropped_rows": (
            "SELECT count(*) + count(*) FILTER (repeated) AS input_rows, count(*) FILTER (late) AS late_rows, "
            "count(*) FILTER (repeated) AS repeated_rows FROM (SELECT event_id % 50 = 7 AND ts < first + INTERVAL 4 DAY AS late, "
            "event_id % 10 = 0 AND ts >= first + INTERVAL 10 DAY AND ts < first + INTERVAL 20 DAY AS repeated "
            "FROM events, (SELECT date_trunc('day', min(ts)) AS first FROM events))"
        ),
    }


def _long(parts: dict[str, tuple[str, str]]) -> str:
    """Long form of several queries: name to (key columns, SQL)."""
    texts = []
    for name, (keys, sql) in parts.items():
        names = [k.strip() for k in keys.split(",")] if keys else []
        key = f"concat_ws('|', {', '.join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in names)})" if names else "''"
        own = ", ".join(names) or "no_key"
        start = f"SELECT {own}, CAST(COLUMNS(* EXCLUDE ({own})) AS DOUBLE) FROM ({sql if names else f'SELECT 0 AS no_key, * FROM ({sql})'})"
        texts.append(f"SELECT '{name}' AS part, {key} AS key, measure, value FROM ({start}) UNPIVOT INCLUDE NULLS (value FOR measure IN (COLUMNS(* EXCLUDE ({own}))))")
    return "\nUNION ALL ".join(texts)


def _bundles() -> dict[str, str]:
    reports, statistics, series, cleaning = _reports(), _statistics(), _series(), _cleaning()

    def of(keys: dict[str, str], names: dict[str, str] | None = None) -> dict[str, tuple[str, str]]:
        """Parts that are registered reports: key columns by part, other report names by part."""
        return {part: (columns, reports[(names or {}).get(part, part)]) for part, columns in keys.items()}

    eda = {
        "basic_stats": ("metric", statistics["describe_numeric"]),
        **of(
            {"hourly_patterns": "pickup_hour", "daily_patterns": "pickup_dayofweek", "weekend_vs_weekday": "is_weekend", "means_by_time": "time_of_day"},
            {"hourly_patterns": "trips_by_hour", "daily_patterns": "trips_by_dayofweek", "weekend_vs_weekday": "trips_by_weekend", "means_by_time": "mean_by_time"},
        ),
        "payment_distribution": ("payment_type", _frequency("payment_type", "v2", "WHERE payment_type IS NOT NULL")),
        "distance_categories": ("trip_distance_category", reports["value_counts"]),
    }
    monthly = (
        f"SELECT g.*, m.trips_ma_3, m.revenue_ma_3 FROM ({series['month_growth']}) g JOIN ({series['moving_average_3']}) m USING (month)"
    )
    statistics_keys = {"overall": "", "by_borough": "pickup_borough", "by_time": "time_of_day", "popular_routes": "pickup_zone, dropoff_zone"}
    return {
        "trip_metrics": _long(
            of({"daily_metrics": "pickup_date", "hourly_metrics": "pickup_date, pickup_hour", "location_metrics": "pu_location_id", "payment_metrics": "payment_type_desc"})
        ),
        "trip_statistics": _long(of(statistics_keys, {"overall": "overall_stats", "by_borough": "borough_stats", "by_time": "time_stats"})),
        "eda_summary": _long(eda),
        "eda_run": _long(
            {
                **eda,
                "distributions": ("metric", statistics["distribution_stats"]),
                "correlations": ("metric_a, metric_b", statistics["correlation_all_numeric"]),
                "fares_by_time": ("time_of_day", statistics["five_number_summary"]),
                "anomalies": ("trip_id, metric", cleaning["iqr_outliers"]),
                "anomaly_counts": ("metric", cleaning["iqr_outlier_counts"]),
                "top_pickups": ("pickup_location_id", reports["value_counts_top_pickups"]),
                "record_count": ("", _with("SELECT count(*) AS record_count FROM v2")),
            }
        ),
        "analysis_bundle": _long(
            {
                **of(
                    {
                        "peak_hours": "pickup_hour, demand_level", "hourly_demand": "pickup_hour", "payment_patterns": "payment_type",
                        "trip_distance_analysis": "trip_distance_category", "rush_hour_impact": "time_of_day",
                        "weekday_weekend_comparison": "day_type", "revenue_by_location": "pickup_location_id", "summary": "",
                        "heatmap": "day_of_week",
                    },
                    {"summary": "summary_report", "heatmap": "demand_heatmap"},
                ),
                "monthly": ("month", monthly),
                "trend": ("metric", series["trend_regression"]),
                "fare_boxes": ("time_of_day", statistics["five_number_summary"]),
                "scatter": (
                    "time_of_day",
                    "SELECT time_of_day, tidy(trip_distance, 6) AS trip_distance, tidy(trip_duration_minutes, 6) AS trip_duration_minutes, "
                    f"tidy(total_amount, 6) AS total_amount FROM ({reports['limit_rows']})",
                ),
                "trend_lines": ("time_of_day", statistics["ols_trend_line"]),
                "radar": ("time_of_day", statistics["zscore_profile"]),
                "correlations": ("metric_a, metric_b", statistics["correlation_matrix"]),
                "basic_stats": ("metric", statistics["basic_stats"]),
                "weekend_ttest": ("", statistics["weekend_ttest"]),
            }
        ),
        **_flows(),
    }


def _flows() -> dict[str, str]:
    """Tables of the flows by file month, which is the month of the raw pickup time."""
    month = "CAST(year(tpep_pickup_datetime) AS INTEGER) AS file_year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS file_month"
    months = "file_year, file_month"
    stored = {"trip_count": "n", "revenue": REVENUE}
    fmd = {"avg_fare": FARE, "avg_distance": MILES, "avg_duration": MINUTES}
    tables1 = {
        "daily_metrics": ("pickup_date", {"total_trips": "n", "total_revenue": REVENUE, "avg_distance": MILES, "avg_duration": MINUTES, "avg_tip_percentage": TIP}),
        "hourly_metrics": ("pickup_date, pickup_hour", {"trips_per_hour": "n", "avg_fare_per_hour": FARE}),
        "location_metrics": ("pu_location_id", {"pickups_count": "n", "avg_fare": FARE, "avg_trip_distance": MILES}),
        "payment_metrics": ("payment_type_desc", {"payment_count": "n", "total_revenue": REVENUE, "avg_tip_percentage": TIP}),
    }
    parts1 = {
        name: (f"{months}, {keys}", _grouped("v1", f"{month}, {keys}", measures)) for name, (keys, measures) in tables1.items()
    } | {"trips": (months, _grouped("v1", month, stored))}
    views = {
        "viz_hourly_patterns": ("pickup_hour", {"total_trips": "n", **fmd}),
        "viz_daily_revenue": (
            "pickup_date",
            {
                "total_trips": "n", "total_revenue": REVENUE, "avg_tip_percentage": TIP,
                "card_revenue": "s:CASE WHEN payment_type_desc = 'credit_card' THEN total_amount ELSE 0 END",
                "cash_revenue": "s:CASE WHEN payment_type_desc = 'cash' THEN total_amount ELSE 0 END",
            },
        ),
        "viz_distance_distribution": ("distance_category", {"trip_count": "n", "avg_fare": FARE, "avg_duration": MINUTES, "avg_tip_percentage": TIP}),
        "viz_payment_analysis": ("payment_type_desc", {"trip_count": "n", "avg_fare": FARE, "avg_tip_percentage": TIP, "avg_distance": MILES}),
        "viz_time_performance": ("time_of_day", {"total_trips": "n", "avg_fare": FARE, "avg_duration": MINUTES, "avg_speed": SPEED, "avg_tip_percentage": TIP}),
        "viz_weekday_weekend": ("day_type", {"total_trips": "n", **fmd, "avg_tip_percentage": TIP}),
        "viz_location_performance": (
            "pu_location_id",
            {
                "total_pickups": "n", "avg_fare": FARE, "avg_distance": MILES, "avg_tip_percentage": TIP,
                "morning_rush_trips": "count(*) FILTER (time_of_day = 'morning_rush')",
                "evening_rush_trips": "count(*) FILTER (time_of_day = 'evening_rush')",
            },
        ),
    }
    analytics = f""",
visual AS (
  SELECT *, trip_distance_category AS distance_category, pickup_location_id AS pu_location_id, {WEEKEND_LABEL},
    CASE payment_type WHEN '1' THEN 'credit_card' WHEN '2' THEN 'cash' WHEN '3' THEN 'no_charge' WHEN '4' THEN 'dispute'
      ELSE 'unknown' END AS payment_type_desc FROM v2
)"""
    parts2 = {name: (keys, _grouped("visual", keys, measures, extra=analytics)) for name, (keys, measures) in views.items()}
    statistics = {
        "overall": ("", {"total_trips": "n", "avg_trip_duration": MINUTES, "avg_distance": MILES, "avg_fare": FARE, "avg_tip": "a:tip_amount", "total_revenue": REVENUE}),
        "by_borough": ("pickup_borough", {"trips": "n", "avg_distance": MILES, "avg_fare": FARE, "total_revenue": REVENUE}),
        "by_time": ("time_of_day", {"trips": "n", "avg_duration": MINUTES, "avg_fare": FARE}),
        "popular_routes": ("pickup_zone, dropoff_zone", {"trip_count": "n", "avg_fare": FARE}),
    }
    first = "SELECT * FROM ({0}) QUALIFY row_number() OVER (PARTITION BY file_year, file_month ORDER BY trip_count DESC, pickup_zone, dropoff_zone) <= 10"
    parts4 = {
        name: (
            ", ".join(filter(None, (months, keys))),
            (first if name == "popular_routes" else "{0}").format(_grouped("v4", ", ".join(filter(None, (month, keys))), measures, 2, extra=_V4)),
        )
        for name, (keys, measures) in statistics.items()
    } | {"trips": (months, _grouped("v4", month, stored, extra=_V4))}
    return {"process_v1": _long(parts1), "process_v2": _long(parts2), "process_v4": _long(parts4)}


_FINANCIAL = {
    "trip_count": "n",
    "avg_fare": FARE,
    "avg_tip_percentage": TIP,
    "avg_cost_per_mile": "a:cost_per_mile",
}


def _series() -> dict[str, str]:
    lagged = (
        "lag(total_trips) OVER (ORDER BY month) AS prev_month_trips, "
        "lag(total_revenue) OVER (ORDER BY month) AS prev_month_revenue"
    )
    trend = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS y, CAST(row_number() OVER (ORDER BY month) - 1 AS DOUBLE) AS x "
        "FROM monthly"
        for m in ("total_trips", "total_revenue", "avg_fare")
    )
    p = _T_P.format(t="t", df="(months - 2)")
    seasonal = """
SELECT month, observed, tidy(trend, 6) AS trend, tidy(seasonal, 6) AS seasonal,
  tidy(observed - trend - seasonal, 6) AS residual
FROM (
  SELECT *, phase_mean - (sum(phase_mean / phase_rows) OVER ()) / 12 AS seasonal
  FROM (
    SELECT *, avg(observed - trend) OVER (PARTITION BY i % 12) AS phase_mean,
      count(*) OVER (PARTITION BY i % 12) AS phase_rows
    FROM (
      SELECT e.month, e.observed, e.i, CASE WHEN e.i < 6 THEN f.a + f.b * e.i WHEN e.i > e.n - 7 THEN g.a + g.b * e.i
        ELSE e.raw_trend END AS trend
      FROM averaged e,
        (SELECT regr_slope(raw_trend, i) AS b, regr_intercept(raw_trend, i) AS a FROM averaged
          WHERE i >= 6 AND i < least(18, n - 7)) f,
        (SELECT regr_slope(raw_trend, i) AS b, regr_intercept(raw_trend, i) AS a FROM averaged
          WHERE i >= greatest(6, n - 19) AND i < n - 7) g
    )
  )
)"""
    averaged = """,
averaged AS (
  SELECT month, CAST(total_trips AS DOUBLE) AS observed, row_number() OVER w - 1 AS i, count(*) OVER () AS n,
    (sum(total_trips) OVER (ORDER BY month ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
      + (lag(total_trips, 6) OVER w + lead(total_trips, 6) OVER w) / 2) / 12 AS raw_trend
  FROM monthly WINDOW w AS (ORDER BY month)
)"""
    return {
        "monthly_metrics": _with("SELECT * FROM monthly", _MONTHLY),
        "monthly_metrics_filled": _with(
            "SELECT CAST(m AS DATE) AS month, coalesce(total_trips, 0) AS total_trips, total_revenue FROM "
            "(SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS m FROM monthly) "
            "LEFT JOIN monthly ON m = month",
            _MONTHLY,
        ),
        "monthly_lag": _with(f"SELECT *, {lagged} FROM monthly", _MONTHLY),
        "month_growth": _with(
            "SELECT *, tidy((total_trips - prev_month_trips) / prev_month_trips * 100, 6) AS trip_growth, "
            "tidy((total_revenue - prev_month_revenue) / prev_month_revenue * 100, 6) AS revenue_growth "
            f"FROM (SELECT *, {lagged} FROM monthly)",
            _MONTHLY,
        ),
        "moving_average_3": _with(
            "SELECT *, CASE WHEN count(*) OVER w = 3 THEN tidy(avg(total_trips) OVER w, 6) END AS trips_ma_3, "
            "CASE WHEN count(*) OVER w = 3 THEN tidy(avg(total_revenue) OVER w, 6) END AS revenue_ma_3 "
            "FROM monthly WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
            _MONTHLY,
        ),
        "location_unit_roots": _with(
            "SELECT pu_location_id, observations, tidy(t, 6) AS statistic, "
            "t < -2.86154 - 2.8903 / observations - 4.234 / observations ** 2 - 40.04 / observations ** 3 AS stationary FROM ("
            "SELECT *, CASE WHEN observations > 3 AND (1 - dz * dz) * (1 - r * r) > 1e-10 "
            "THEN r * sqrt((observations - 3) / (1 - r * r)) END AS t FROM ("
            "SELECT *, CASE WHEN 1 - xz * xz > 1e-10 AND 1 - dz * dz > 1e-10 THEN (xd - xz * dz) / sqrt((1 - xz * xz) * (1 - dz * dz)) END AS r FROM ("
            "SELECT pu_location_id, count(z) AS observations, CASE WHEN min(z) < max(z) AND min(x) < max(x) THEN corr(x, z) END AS xz, "
            "CASE WHEN min(z) < max(z) AND min(d) < max(d) THEN corr(d, z) END AS dz, "
            "CASE WHEN min(x) < max(x) AND min(d) < max(d) THEN corr(x, d) END AS xd FROM ("
            "SELECT pu_location_id, d, CASE WHEN z IS NOT NULL THEN x END AS x, z FROM ("
            "SELECT pu_location_id, x, y - x AS d0, CASE WHEN lag(y - x) OVER w IS NOT NULL THEN y - x END AS d, lag(y - x) OVER w AS z FROM ("
            "SELECT pu_location_id, date, y, lag(y) OVER (PARTITION BY pu_location_id ORDER BY date) AS x FROM ("
            "SELECT pu_location_id, pickup_date AS date, count(*) AS y FROM v1 GROUP BY ALL)) "
            "WINDOW w AS (PARTITION BY pu_location_id ORDER BY date))) GROUP BY pu_location_id)))",
        ),
        "trend_regression": _with(
            "SELECT metric, tidy(slope, 5) AS slope, tidy(r_squared, 5) AS r_squared, tidy(mean, 5) AS mean, "
            "tidy(std, 5) AS std, tidy(min, 5) AS min, tidy(max, 5) AS max, months, "
            f"tidy({p}, 5) AS p_value FROM (SELECT *, sqrt(r_squared * (months - 2) / (1 - r_squared)) AS t FROM "
            "(SELECT metric, regr_slope(y, x) AS slope, regr_r2(y, x) AS r_squared, avg(y) AS mean, stddev_samp(y) AS std, "
            f"min(y) AS min, max(y) AS max, CAST(regr_count(y, x) AS BIGINT) AS months FROM ({trend}) GROUP BY ALL))",
            _MONTHLY,
        ),
        "seasonal_decompose": _with(seasonal, _MONTHLY + averaged),
    }


def _statistics() -> dict[str, str]:
    core = ("total_amount", "trip_distance", "trip_duration_minutes", "tip_percentage", "speed_mph")
    numeric = (
        "passenger_count", "trip_distance", "pickup_location_id", "dropoff_location_id", "fare_amount", "tip_amount",
        "total_amount", "pickup_hour", "pickup_day", "pickup_month", "pickup_year", "pickup_dayofweek",
        "trip_duration_minutes", "speed_mph", "cost_per_mile", "cost_per_minute", "tip_percentage",
    )

    def each(columns, template: str, source: str = "v2", extra: str = "") -> str:
        return _with(" UNION ALL ".join(f"SELECT '{c}' AS metric, {template.format(c=c)} FROM {source.format(c=c)}" for c in columns), extra)

    def matrix(columns) -> str:
        pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
        cells = ", ".join(f"corr({a}, {b}) AS r{i}" for i, (a, b) in enumerate(pairs))
        rows = [f"('{c}', '{c}', 1.0::DOUBLE)" for c in columns]
        rows += [f"('{x}', '{y}', tidy(r{i}, 6))" for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))]
        return _with(
            "SELECT u.metric_a, u.metric_b, u.r FROM wide, LATERAL (VALUES " + ", ".join(rows) + ") u(metric_a, metric_b, r)",
            f",\nwide AS (SELECT {cells} FROM v2)",
        )

    quartiles = "quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q3"

    def boxes(key: str, value: str) -> str:
        inside = f"{value} >= q1 - 1.5 * (q3 - q1) AND {value} <= q3 + 1.5 * (q3 - q1)"
        return _with(
            f"SELECT {key}, count(*) AS n, tidy(min({value}), 6) AS minimum, "
            f"tidy(min({value}) FILTER ({inside}), 6) AS lower_whisker, tidy(q1, 6) AS q1, tidy(median, 6) AS median, "
            f"tidy(q3, 6) AS q3, tidy(max({value}) FILTER ({inside}), 6) AS upper_whisker, "
            f"tidy(max({value}), 6) AS maximum, count(*) FILTER (NOT ({inside})) AS outliers "
            f"FROM v2 JOIN (SELECT {key}, {quartiles.format(v=value)} FROM v2 GROUP BY ALL) USING ({key}) "
            f"GROUP BY {key}, q1, median, q3"
        )

    def ttest(keys: str) -> str:
        lead = f"{keys}, " if keys else ""
        grouping = f"GROUP BY {keys}" if keys else ""
        sides = ", ".join(
            f"count(total_amount) FILTER ({c}) AS n_{s}, avg(total_amount) FILTER ({c}) AS mean_{s}, "
            f"var_samp(total_amount) FILTER ({c}) AS var_{s}"
            for s, c in (("weekday", "NOT is_weekend"), ("weekend", "is_weekend"))
        )
        return (
            f",\nsides AS (SELECT {lead}{sides} FROM v2 {grouping}),\ntested AS (SELECT *, n_weekday + n_weekend - 2 AS v, "
            "(mean_weekday - mean_weekend) / sqrt(((n_weekday - 1) * var_weekday + (n_weekend - 1) * var_weekend) "
            "/ (n_weekday + n_weekend - 2) * (1 / n_weekday + 1 / n_weekend)) AS t FROM sides)"
        )

    p = _T_P.format(t="t", df="v")
    z = ", ".join(
        f"tidy(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"
        for c in ("avg_speed", "avg_fare", "avg_tip", "avg_distance")
    )
    v1_columns = (
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "pu_location_id",
        "do_location_id", "payment_type", "fare_amount", "tip_amount", "total_amount", "pickup_date", "pickup_hour",
        "pickup_day", "pickup_month", "pickup_year", "pickup_dayofweek", "trip_duration_minutes", "is_weekend",
        "time_of_day", "speed_mph", "distance_category", "is_long_trip", "cost_per_mile", "cost_per_minute",
        "tip_percentage", "payment_type_desc",
    )
    return {
        "describe_numeric": each(
            numeric,
            "count({c}) AS count, tidy(avg({c}), 5) AS mean, tidy(stddev_samp({c}), 5) AS std, "
            "tidy(CAST(min({c}) AS DOUBLE), 5) AS min, tidy(quantile_cont({c}::DOUBLE, 0.25), 5) AS q25, "
            "tidy(quantile_cont({c}::DOUBLE, 0.5), 5) AS q50, tidy(quantile_cont({c}::DOUBLE, 0.75), 5) AS q75, "
            "tidy(CAST(max({c}) AS DOUBLE), 5) AS max",
        ),
        "basic_stats": each(
            core,
            "tidy(avg({c}), 6) AS mean, tidy(stddev_samp({c}), 6) AS std, tidy(skewness({c}), 6) AS skew, "
            "tidy(kurtosis({c}), 6) AS kurtosis, tidy(quantile_cont({c}, 0.5), 6) AS median",
        ),
        "distribution_stats": each(
            numeric,
            "tidy(avg({c}), 6) AS mean, tidy(stddev_samp({c}), 6) AS std, tidy(skewness({c}), 6) AS skew, "
            "tidy(quantile_cont({c}::DOUBLE, 0.5), 6) AS median",
        ),
        "correlation_matrix": matrix(core),
        "correlation_all_numeric": matrix(numeric),
        "weekend_ttest": _with(
            "SELECT n_weekday, n_weekend, tidy(mean_weekday, 6) AS mean_weekday, tidy(mean_weekend, 6) AS mean_weekend, "
            f"tidy(t, 6) AS t_statistic, v AS degrees, tidy({p}, 6) AS p_value FROM tested",
            ttest(""),
        ),
        "t_pvalue": _with(
            f"SELECT pickup_location_id, tidy(t, 6) AS t_statistic, v AS degrees, tidy({p}, 6) AS p_value FROM tested",
            ttest("pickup_location_id"),
        ),
        "five_number_summary": boxes("time_of_day", "total_amount"),
        "five_number_summary_by_payment": boxes("payment_type", "total_amount"),
        "violin_density": _with(
            """SELECT is_weekend, CAST(i AS INTEGER) AS point, tidy(x, 6) AS x,
  tidy(sum(c * exp(-0.5 * pow((x - centre) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 6) AS density
FROM (SELECT *, low + i * (high - low) / 63 AS x FROM binned, range(0, 64) r(i)) GROUP BY is_weekend, i, x""",
            """,
shape AS (SELECT is_weekend, min(total_amount) AS low, max(total_amount) AS high, count(total_amount) AS n,
  stddev_samp(total_amount) * pow(count(total_amount), -0.2) AS h FROM v2 GROUP BY ALL),
binned AS (SELECT is_weekend, low, high, n, h, low + (b - 0.5::DOUBLE) * (high - low) / 128 AS centre, count(*) AS c FROM
  (SELECT shape.*, least(CAST(floor(128 * (total_amount - low) / (high - low)) AS INTEGER) + 1, 128) AS b
   FROM v2 JOIN shape USING (is_weekend)) GROUP BY ALL)""",
        ),
        "histogram_bins": _with(
            "SELECT CAST(i AS INTEGER) AS bin, tidy(low + (i - 1) * (high - low) / 50, 6) AS bin_start, "
            "tidy(low + i * (high - low) / 50, 6) AS bin_end, coalesce(c, 0) AS row_count FROM edges, range(1, 51) r(i) "
            "LEFT JOIN (SELECT least(CAST(floor(50 * (cost_per_mile - low) / (high - low)) AS INTEGER) + 1, 50) AS b, "
            "count(*) AS c FROM v2, edges WHERE cost_per_mile IS NOT NULL GROUP BY ALL) ON b = i",
            ",\nedges AS (SELECT min(cost_per_mile) AS low, max(cost_per_mile) AS high FROM v2)",
        ),
        "auto_histogram": each(
            numeric,
            "CAST(b + 1 AS INTEGER) AS bin, tidy(low + b * (span / bins), 6) AS bin_start, tidy(low + (b + 1) * (span / bins), 6) AS bin_end, "
            "c AS row_count, CASE WHEN span > 0 THEN tidy(c / (n * (span / bins)), 6) END AS density",
            "shape_{c}, binned_{c}",
            "".join(
                f""",
shape_{c} AS (SELECT *, CASE WHEN span > 0 THEN CAST(ceil(span / CASE WHEN wide > 0 THEN least(wide, close) ELSE close END) AS INTEGER) ELSE 1 END AS bins
  FROM (SELECT count({c}) AS n, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) - CAST(min({c}) AS DOUBLE) AS span,
    2 * (quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25)) / pow(count({c}), 1 / 3) AS wide,
    (CAST(max({c}) AS DOUBLE) - CAST(min({c}) AS DOUBLE)) / (log2(count({c})) + 1) AS close FROM v2)),
binned_{c} AS (SELECT CASE WHEN span > 0 THEN least(CAST(floor(({c}::DOUBLE - low) * bins::DOUBLE / span) AS BIGINT), bins - 1) ELSE 0 END AS b, count(*) AS c
  FROM v2, shape_{c} WHERE {c} IS NOT NULL GROUP BY ALL)"""
                for c in numeric
            ),
        ),
        "ols_trend_line": _with(
            "SELECT time_of_day, tidy(regr_slope(y, x), 6) AS slope, tidy(regr_intercept(y, x), 6) AS intercept, "
            "tidy(regr_r2(y, x), 6) AS r_squared, CAST(regr_count(y, x) AS BIGINT) AS points FROM "
            "(SELECT time_of_day, trip_duration_minutes AS y, trip_distance AS x FROM v2) GROUP BY ALL"
        ),
        "zscore_profile": _with(
            f"SELECT time_of_day, {z} FROM (SELECT time_of_day, avg(speed_mph) AS avg_speed, avg(total_amount) AS avg_fare, "
            "avg(tip_percentage) AS avg_tip, avg(trip_distance) AS avg_distance FROM v2 GROUP BY ALL)"
        ),
        "null_profile": _with(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM v1" for c in v1_columns
            )
        ),
        "value_ranges": each(
            ("trip_distance", "total_amount", "trip_duration_minutes"),
            "tidy(min({c}), 6) AS min_value, tidy(max({c}), 6) AS max_value",
        ),
    }


# Date columns of each result; both sides present them as ISO text.
_DATES = {
    "pickup_date": (
        "scan_month_table", "fetch_month", "write_trips_partitioned", "recent_window_filter", "pickup_date",
        "features_v1", "features_v2", "features_local", "daily_metrics", "hourly_metrics", "viz_daily_revenue",
        "union_months",
    ),
    "month_start": ("month_range", "month_start"),
    "date": ("date_hour_extract", "daily_metrics_zone_join", "daily_location_rollup", "incremental_rollup", "chart_daily_revenue"),
    "month": (
        "monthly_metrics", "monthly_metrics_filled", "monthly_lag", "month_growth", "moving_average_3",
        "seasonal_decompose",
    ),
}


# Integer columns with nulls, presented as doubles on both sides.
_SPARSE_COUNTS = {
    "passenger_count": ("scan_parquet_schema", "fetch_month", "features_v2", "features_local"),
    "prev_month_trips": ("monthly_lag", "month_growth"),
}


def oracle_sql() -> dict[str, str]:
    found = {
        **_sources(),
        **_cleaning(),
        **_derived(),
        **_zone_joins(),
        **_reports(),
        **_bundles(),
        **_series(),
        **_statistics(),
    }
    found = {name: _expand(text) for name, text in found.items()}
    for kind, columns in (("VARCHAR", _DATES), ("DOUBLE", _SPARSE_COUNTS)):
        for column, names in columns.items():
            for name in names:
                found[name] = f"SELECT * REPLACE (CAST({column} AS {kind}) AS {column}) FROM ({found[name]})"
    return found
