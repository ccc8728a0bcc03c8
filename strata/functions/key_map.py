"""Stored keys (F18, G6): dense ids that can't collide and stay as they are over runs.

A hash of the natural key needs no table but two keys may share one, likely at some 10^10 rows. A key map is a table
of natural keys and ids. A run gives new keys the ids after the largest one, in key order: a range partitioning by key
and the row counts of the ranges make positions without a sort in one task. Stored keys keep their ids.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from strata.session import scratch_path
from strata.sources.versions import Lake, Version


def numbered(rows: DataFrame, by: Sequence[Column], name: str, start: int = 1) -> DataFrame:
    """Rows with ``name``: dense numbers from ``start`` on in the order of ``by``."""
    spark = rows.sparkSession
    path = scratch_path(spark, "numbered")
    # the place of a row is fixed by writing it: ranges in the high bits, rows of a range in the low ones
    rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema(StructType([*rows.schema.fields, StructField("_place", LongType())])).parquet(path)
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    ranges = placed.groupBy("_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    shift = ranges.select("_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + start).alias("_shift"))
    return placed.join(F.broadcast(shift), "_range").withColumn(name, F.col("_place") + F.col("_shift")).drop("_place", "_range", "_shift")


def same_key(a: DataFrame, b: DataFrame, key: Sequence[str]) -> Column:
    """Equal keys, null being a value like any other."""
    return reduce(Column.__and__, [a[c].eqNullSafe(b[c]) for c in key])


def assign_ids(lake: Lake, base: Version | None, table: str, keys: DataFrame, key: Sequence[str], name: str) -> list[str]:
    """Stage the ids of the keys that ``table`` lacks; returns the table's folders with them."""
    schema = StructType([*[keys.schema[c] for c in key], StructField(name, LongType())])
    folders = list(base.folders(table)) if base else []
    stored = lake.read_folders(table, schema, folders)
    distinct = keys.select(*key).distinct()
    new = distinct.join(stored, same_key(distinct, stored, key), "left_anti")
    last = stored.agg(F.max(name)).first()[0] or 0
    return sorted([*folders, *lake.stage(numbered(new, [F.col(c).asc_nulls_first() for c in key], name, last + 1), table)])


def key_map(lake: Lake, table: str, key_fields: Sequence[StructField], name: str, version: Version | None = None) -> DataFrame:
    """The stored map: key columns and ``name``."""
    return lake.read(table, StructType([*key_fields, StructField(name, LongType())]), version)
