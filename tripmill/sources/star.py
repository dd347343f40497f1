"""Trip and zone tables derived from the order/lineitem star schema.

Each order line becomes one trip. All offsets are integer arithmetic, so any
engine derives bit-identical values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.sources.files import spread_rows

# Fixed values of the mapping.
SECONDS_PER_DAY = 86_400
LOCATIONS = 97


_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is read from a footer once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the date of their order: the columns that trips are made from.

    Both inputs grow with the data: no broadcast hint here. The engine picks
    the join from file sizes and splits skewed order keys at run time.
    """
    lines = spread_rows(
        read_table(spark, folder, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
        ),
        "l_orderkey",
    )
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def _times() -> tuple[Column, Column]:
    """Pickup and dropoff of an order line."""
    start = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 613) % SECONDS_PER_DAY
    length = F.col("l_quantity").cast("long") * 60 + F.col("l_partkey") * 7 % 60
    return tuple(F.timestamp_add("SECOND", seconds.cast("int"), F.col("o_orderdate")) for seconds in (start, start + length))


def as_trips(lines: DataFrame) -> DataFrame:
    """One trip per order line, in raw-style column names."""
    pickup, dropoff = _times()
    fare = F.col("l_extendedprice") / 1000
    tip = fare * F.col("l_discount")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trip_id"),
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        ((F.col("l_partkey") * 13 + F.col("l_linenumber") * 101) % 2500 / 100).alias("trip_distance"),
        (F.col("l_suppkey") + 1).cast("int").alias("pu_location_id"),
        (F.col("l_partkey") % LOCATIONS + 1).cast("int").alias("do_location_id"),
        (F.col("l_orderkey") % 5 + 1).cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        (fare + tip).alias("total_amount"),
        F.col("l_orderkey").alias("order_key"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per order line (:func:`as_trips`)."""
    return as_trips(lines(spark, folder))


def trips_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The blemished trips, rebalanced by pickup month while they are order lines, which are narrower."""
    found = lines(spark, folder)
    pickup, dropoff = _times()
    pickup = F.when(_swapped(F.col("l_orderkey")), dropoff).otherwise(pickup)
    dealt = found.withColumn("_month", F.year(pickup) * 12 + F.month(pickup)).hint("rebalance", "_month")
    return blemish(as_trips(dealt))


def _swapped(key: Column) -> Column:
    """Orders whose trips have their times swapped."""
    return key % 83 == 0


def blemish(df: DataFrame) -> DataFrame:
    """The same trips with blanked values and swapped timestamps, for cleaning checks.

    All rows stay; every order's lines are treated alike.
    """
    key = F.col("order_key")
    swapped = _swapped(key)
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return df.withColumns(
        {
            "passenger_count": F.when(key % 97 != 0, F.col("passenger_count")),
            "trip_distance": F.when(key % 89 != 0, F.col("trip_distance")),
            "tpep_pickup_datetime": F.when(swapped, dropoff).otherwise(pickup),
            "tpep_dropoff_datetime": F.when(swapped, pickup).otherwise(dropoff),
        }
    )


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Zone lookup, one zone per supplier: LocationID, Borough and Zone."""
    supplier = read_table(spark, folder, "supplier")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, folder, "region").select("r_regionkey", "r_name")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("s_suppkey") + 1).cast("int").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("s_name").alias("Zone"),
        )
    )
