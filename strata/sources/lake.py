"""Parquet lake tables: scans (S3, S4), sinks (S5, S6), missing tables (S10), lineage
cuts (S12) and caching (S13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import ensure_checkpoint_dir
from strata.sources.bronze import file_inventory


class MissingTable(RuntimeError):
    """A lake table that should exist does not."""


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """S3: Parquet directory, Hive partitions restored as columns.

    Passing the schema fixes partition column types (an all-NULL partition column would
    otherwise come back as ``void``) and skips footer-based inference.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise MissingTable(f"{path}: {exc}") from exc


def read_table_files(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Every Parquet file below ``path`` regardless of layout, skipping unreadable
    files (``files_without_rows`` names them); partition columns are not restored
    (directory names are not parsed). Without a schema all readable footers are merged, so
    the result does not depend on which file sorts first."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    return (
        reader.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", True)
        .parquet(path)
    )


def files_without_rows(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Files below ``path`` of which ``read_table_files`` returns nothing: skipped as unreadable, or empty.

    Both sides read metadata only (the listing; row counts of the footers), so a file with a
    good footer and a bad page is not named.
    """
    listed = file_inventory(spark, path, "*.parquet").select("path", "length")
    seen = read_table_files(spark, path, schema).select(F.col("_metadata.file_path").alias("path")).distinct()
    return listed.join(seen, "path", "left_anti")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                max_records_per_file: int | None = None, replace_partitions_only: bool = False) -> None:
    """Parquet (Snappy) write; partitioned by ``partition_by`` when given.

    Before a partitioned write the rows are rebalanced on the partition columns. Unlike
    ``repartition(cols)``, a rebalance lets AQE split a partition value that is too large
    (a busy month) into several tasks and files and merge the small ones, so neither one
    giant task nor thousands of tiny files appear. Task retries after an executor loss are
    handled by the file commit protocol.

    ``replace_partitions_only`` overwrites just the partitions present in ``df`` (dynamic
    partition overwrite): reprocessing one month rewrites that month, not the table.
    """
    writer_df = df.hint("rebalance", *partition_by) if partition_by else df
    w = writer_df.write.mode(mode)
    if replace_partitions_only:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def table_or_none(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table, or ``None`` if its folder does not exist or holds no data files."""
    try:
        df = read_table(spark, path, schema)
    except MissingTable:
        return None
    return df if df.inputFiles() else None


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss;
    never a local checkpoint). Note it is a barrier: later filters are not pushed below."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def console(df: DataFrame, n: int = 20) -> None:
    """Print the first ``n`` rows untruncated (an action; for interactive use)."""
    df.show(n, truncate=False)


def cached(df: DataFrame) -> DataFrame:
    """Keep a frame that several panels reuse; lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
