"""The incremental load as a Structured Streaming file stream.

New bronze files are picked up by the file source; each micro-batch is cleaned by the
silver function (dedup within the batch) and appended after dropping keys already in the
target table. The stream checkpoint (in the shared checkpoint folder) replaces the state
file; keeping the seen keys in the target table instead of an unbounded streaming
``dropDuplicates`` state keeps the state store small. A micro-batch that is re-run after a
failure appends only keys that are still absent, so a retry does not duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.operators.join import keys_absent_from
from strata.schemas import BRONZE_CRASH
from strata.session import scratch_path
from strata.sources.lake import table_or_none, write_table


def read_bronze_stream(spark: SparkSession, path_glob: str, schema: StructType = BRONZE_CRASH,
                       multi_line: bool = True, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming scan of bronze JSON files (explicit schema, PERMISSIVE), so many files a micro-batch:
    a backlog is worked off in bounded steps."""
    reader = spark.readStream.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).json(path_glob)


def stream_into_table(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target_path: str,
                      schema: StructType, key: Sequence[str], checkpoint_location: str | None = None,
                      partition_by: Sequence[str] = ("year", "month"), available_now: bool = True,
                      wait: bool = True) -> StreamingQuery:
    """Run ``stream → transform → append new keys`` with ``foreachBatch``.

    ``available_now`` processes everything present and stops (a scheduled incremental
    run); otherwise the query keeps running with the default trigger.
    """
    spark = stream.sparkSession
    checkpoint_location = checkpoint_location or scratch_path(spark, "stream-checkpoint")
    key = list(key)
    columns = schema.fieldNames()

    def _append(batch: DataFrame, _epoch: int) -> None:
        rows = transform(batch).select(*columns)
        target = table_or_none(batch.sparkSession, target_path, schema)
        if target is None:
            write_table(rows, target_path, partition_by, mode="append")
            return
        # the cleaned batch feeds both the key probe and the append: keep it for the
        # duration of the batch (memory and disk; recomputed from the batch's files if lost)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_table(keys_absent_from(rows, target, key), target_path, partition_by, mode="append")
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(_append).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    query = writer.start()
    if wait:
        query.awaitTermination()
    return query
