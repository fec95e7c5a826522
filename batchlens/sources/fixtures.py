"""Adapters that turn the driver's tables into trip-shaped event tables (FIXTURES.md §2).

Each adapter has a Spark form and the same query as DuckDB SQL (the oracle side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.operators.features import nan_as_null
from batchlens.operators.sequence import next_value_in_group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to orders, shaped as dirty trips (nulls, negatives, out-of-range coordinates)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    c = F.col
    df = j.select(
        c("o_orderdate").alias("pickup_ts"),
        c("l_shipdate").alias("dropoff_ts"),
        (c("l_extendedprice") - 2000).alias("total_amount"),
        (c("l_quantity") - 2).alias("trip_distance"),
        F.when(c("l_linenumber") == 7, None).otherwise(c("l_linenumber")).alias("passenger_count"),
        (c("l_suppkey") % 2 + 1).alias("vendor_id"),
        F.when(c("l_partkey") % 10 == 0, None).otherwise(c("l_partkey") % 6 + 1).alias("ratecode_id"),
        F.when((c("l_linestatus") == "O") & (c("l_linenumber") == 1), None)
        .otherwise(c("l_returnflag"))
        .alias("store_flag"),
        (c("l_partkey") % 370 - 185).cast("double").alias("pickup_longitude"),
        (c("l_suppkey") % 100 - 50).cast("double").alias("pickup_latitude"),
        (c("l_orderkey") % 362 - 181).cast("double").alias("dropoff_longitude"),
        (c("l_partkey") % 100 - 50).cast("double").alias("dropoff_latitude"),
        c("l_orderkey").alias("_orderkey"),
    )
    return nan_as_null(df)


def trips_li_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips_li`` plus a second copy of every row with ``l_orderkey % 50 = 0`` (full-row duplicates)."""
    base = trips_li(spark, sf_dir)
    return base.unionByName(base.where(F.col("_orderkey") % 50 == 0)).drop("_orderkey")


def trips_li_clean_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_li(spark, sf_dir).drop("_orderkey")


def trips_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the user's next event time as the end time (skew-safe lead, see ``next_value_in_group``)."""
    ev = table(spark, sf_dir, "events")
    df = next_value_in_group(
        ev.select("event_id", "user_id", "ts", "value", "event_type", "props"),
        key="user_id",
        order=["ts", "event_id"],
        value="ts",
        out="dropoff_ts",
        bucket=F.to_date("ts"),
    )
    c = F.col
    df = df.select(
        "event_id",
        "user_id",
        c("ts").alias("pickup_ts"),
        "dropoff_ts",
        c("value").alias("total_amount"),
        c("event_type").alias("store_flag"),
        (c("user_id") % 6 + 1).alias("passenger_count"),
        F.get_json_object("props", "$.k").cast("double").alias("trip_distance"),
    )
    return nan_as_null(df)


def trips_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips_ev`` with a target that its features explain (but for a remainder that rises with the event id)."""
    c = F.col
    target = F.coalesce(c("trip_distance"), F.lit(0.0)) * 0.3 + c("passenger_count") * 10 + c("event_id") % 7
    return trips_ev(spark, sf_dir).withColumn("total_amount", target.cast("double"))


ADAPTERS = {"trips_li": trips_li_clean_input, "trips_li_dup": trips_li_dup, "trips_ev": trips_ev, "trips_signal": trips_signal}


# ---- the same adapters as DuckDB SQL (oracle side) ----

TRIPS_LI_SQL = """
select o_orderdate pickup_ts, l_shipdate dropoff_ts,
       l_extendedprice - 2000 total_amount, l_quantity - 2 trip_distance,
       case when l_linenumber = 7 then null else l_linenumber end passenger_count,
       l_suppkey % 2 + 1 vendor_id,
       case when l_partkey % 10 = 0 then null else l_partkey % 6 + 1 end ratecode_id,
       case when l_linestatus = 'O' and l_linenumber = 1 then null else l_returnflag end store_flag,
       cast(l_partkey % 370 - 185 as double) pickup_longitude,
       cast(l_suppkey % 100 - 50 as double) pickup_latitude,
       cast(l_orderkey % 362 - 181 as double) dropoff_longitude,
       cast(l_partkey % 100 - 50 as double) dropoff_latitude,
       l_orderkey _orderkey
from lineitem join orders on l_orderkey = o_orderkey
"""

TRIPS_LI_COLS = (
    "pickup_ts, dropoff_ts, total_amount, trip_distance, passenger_count, vendor_id, ratecode_id, store_flag, "
    "pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude"
)

TRIPS_EV_SQL = """
select event_id, user_id, ts pickup_ts,
       lead(ts) over (partition by user_id order by ts, event_id) dropoff_ts,
       value total_amount, event_type store_flag, user_id % 6 + 1 passenger_count,
       cast(json_extract_string(props, '$.k') as double) trip_distance
from events
"""


def adapter_sql(name: str) -> str:
    """A CTE body for the named adapter."""
    if name == "trips_li":
        return f"select {TRIPS_LI_COLS} from ({TRIPS_LI_SQL}) t"
    if name == "trips_li_dup":
        return (
            f"select {TRIPS_LI_COLS} from ({TRIPS_LI_SQL}) t union all "
            f"select {TRIPS_LI_COLS} from ({TRIPS_LI_SQL}) t where _orderkey % 50 = 0"
        )
    if name == "trips_ev":
        return TRIPS_EV_SQL
    if name == "trips_signal":
        target = "cast(coalesce(trip_distance, 0.0) * 0.3 + passenger_count * 10 + event_id % 7 as double) as total_amount"
        return f"select * replace ({target}) from ({TRIPS_EV_SQL}) t"
    raise KeyError(name)
