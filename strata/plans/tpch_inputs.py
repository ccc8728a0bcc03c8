"""The driver's star-schema tables seen as crash and video records.

Domain functions work on column names; these projections give the generic test tables
those names, so the very same plans run on them:

  crash_record_id      ← l_orderkey "-" l_linenumber   (not unique: exercises dedup)
  crash_date           ← l_shipdate
  weather_condition    ← l_returnflag                  (bad weather: A, R)
  lighting_condition   ← l_linestatus                  (night: F)
  first_crash_type     ← "D" || round(l_discount * 100)
  roadway_surface_cond ← "T" || round(l_tax * 100)
  latitude, longitude  ← l_suppkey, nullif(l_linenumber, 7)
  injuries_total       ← l_quantity
  injuries_fatal       ← 1.0 if l_quantity >= 49 else 0.0
  video_id, title, channel, published_at ← o_orderkey, o_orderpriority, o_orderstatus, o_orderdate
  timed events (hour of day) ← events.event_id, events.ts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BAD_WEATHER = ("A", "R")
NIGHT = ("F",)
BOX = (10.0, 40.0, 2.0, 5.0)
GRID_CELL = 10.0
INCREMENTAL_CUT = "1999-01-01"


# Schemas of the driver tables this package reads. Passing them skips the footer-reading
# inference job that ``spark.read.parquet`` otherwise runs for every scan.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its fixed schema."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crashes_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("crash_record_id"),
        F.col("l_shipdate").alias("crash_date"),
        F.col("l_returnflag").alias("weather_condition"),
        F.col("l_linestatus").alias("lighting_condition"),
        F.concat(F.lit("D"), F.round(F.col("l_discount") * 100).cast("int").cast("string")).alias("first_crash_type"),
        F.concat(F.lit("T"), F.round(F.col("l_tax") * 100).cast("int").cast("string")).alias("roadway_surface_cond"),
        F.col("l_suppkey").cast("double").alias("latitude"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).cast("double").alias("longitude"),
        F.col("l_quantity").alias("injuries_total"),
        (F.col("l_quantity") >= 49).cast("int").cast("double").alias("injuries_fatal"),
    )


def videos_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("channel"),
        F.col("o_orderdate").alias("published_at"),
    )


def timed_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").cast("string").alias("crash_record_id"), F.col("ts").alias("crash_date"))
