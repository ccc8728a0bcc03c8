"""Event counts kept by the stream itself (T2): duplicates dropped and days counted within a watermark.

``file_stream`` keeps the keys it has seen in the target table. Here the state store keeps them, as long as the
watermark asks: a key that comes again within ``delay`` of its first event counts once, and a day's count is final
``delay`` after the day's end. Rows later than that are dropped, as the bound on the state demands. State lives in RocksDB,
so it is bounded by disk, not by the heap, and its snapshots lie in the stream's checkpoint: a restart goes on
with the same counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAYS = "day date, n long"


def _in_utc(events: DataFrame, ts: str) -> Column:
    """The event time as an instant; a time without a zone is taken as UTC, whatever the session's zone is."""
    if isinstance(events.schema[ts].dataType, TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(ts)).cast("timestamp")
    return F.col(ts).cast("timestamp")


def daily_counts(events: DataFrame, ts: str, key: str, delay: str = "2 days") -> DataFrame:
    """``day`` (in UTC) and ``n``, the distinct keys of each day, of a stream or a batch of events; rows without a time or
    key are left out."""
    known = events.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).select(F.col(key), _in_utc(events, ts).alias("_time"))
    once = known.withWatermark("_time", delay)
    once = once.dropDuplicatesWithinWatermark([key]) if events.isStreaming else once.dropDuplicates([key])
    counted = once.groupBy(F.window("_time", "1 day").alias("_window")).agg(F.count("*").alias("n"))
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("_window.start").cast("timestamp_ntz"))
    return counted.select(F.to_date(start).alias("day"), "n")


def count_days(spark: SparkSession, events: DataFrame, ts: str, key: str, out: str, checkpoint: str, delay: str = "2 days") -> StreamingQuery:
    """Append each finished day's count to ``out`` (Parquet, written exactly once); processes what is there and stops."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        query = (daily_counts(events, ts, key, delay).writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return query


def monthly_counts(days: DataFrame) -> DataFrame:
    """Counts of months from those of days."""
    return days.groupBy(F.year("day").alias("year"), F.month("day").alias("month")).agg(F.sum("n").alias("n"))
