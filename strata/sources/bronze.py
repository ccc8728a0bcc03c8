"""Bronze JSON: scans (S1, S2), landing (S7) and file inventory.

Raw files are JSON arrays, one file per fetch, under ``<root>/YYYY-MM-DD/``. They are read
with an explicit all-string schema (no inference pass over the data) in PERMISSIVE mode:
a malformed file lands in ``_corrupt_record`` instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.defaults import SOURCE_BRONZE_CRASH
from strata.functions.audit import epoch_batch_id, ingest_date, with_audit
from strata.schemas import BRONZE_CRASH, BRONZE_VIDEO

CORRUPT = "_corrupt_record"
#: How JSON lines are written: packed at the fastest level, to some tenth of the text. A packed file can't be split, and
#: Spark fills a read task with files by their size, to which it adds a cost for opening; so small files bound a task's rows.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 50_000}


def _with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def read_json(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True,
              recursive: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Scan JSON with a fixed schema. ``multi_line`` for array / pretty-printed files (the
    API pages); ``False`` for JSON lines (what Spark writes). ``recursive`` descends into
    dated sub-folders that are not ``k=v`` partitions."""
    reader = (
        spark.read.schema(_with_corrupt(schema) if keep_corrupt else schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,json.gz}")
    return reader.json(path)


def read_bronze_crashes(spark: SparkSession, path_glob: str, multi_line: bool = True,
                        keep_corrupt: bool = False) -> DataFrame:
    """Crash pages by glob, e.g. ``<root>/*/*.json``."""
    return read_json(spark, path_glob, BRONZE_CRASH, multi_line=multi_line, keep_corrupt=keep_corrupt)


def read_bronze_videos(spark: SparkSession, root: str, multi_line: bool = True,
                       keep_corrupt: bool = False) -> DataFrame:
    """Video hits under ``root`` including dated sub-folders, flat or nested shape."""
    return read_json(spark, root, BRONZE_VIDEO, multi_line=multi_line, recursive=True, keep_corrupt=keep_corrupt)


def quarantined(raw: DataFrame) -> DataFrame:
    """The malformed records of a scan with ``keep_corrupt``, with their file. A page that can't
    be parsed as a whole is one record."""
    return raw.filter(F.col(CORRUPT).isNotNull()).select("*", F.col("_metadata.file_path").alias("file"))


def malformed(raw: DataFrame, feed: str) -> DataFrame:
    """P12, as the daily load keeps it: feed, file, a malformed record's text, and the rows that the scan made of
    it and of which it could read anything. Every row of an array page with one bad entry holds the whole page as
    its text, so a text is kept once a file.

    The last count also makes the scan parse every column: a record is malformed only in columns that are read.
    """
    fields = [F.col(c) for c in raw.columns if c != CORRUPT]
    return raw.filter(F.col(CORRUPT).isNotNull()).groupBy(
        F.lit(feed).alias("feed"), F.col("_metadata.file_path").alias("path"), F.col(CORRUPT).alias("record")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.coalesce(*[c.cast("string") for c in fields])).alias("n_read"))


def land_bronze(raw: DataFrame, out_root: str, event_time: str = "crash_date",
                source: str = SOURCE_BRONZE_CRASH, batch_id: str | None = None) -> DataFrame:
    """Stamp audit columns, drop records without an event time, and append them
    under ``ingest_date=YYYY-MM-DD`` as packed JSON lines (``*.json.gz``). Returns the landed frame (lazy; the
    write is the action). Re-aimed from HTTP polling: ``raw`` is already on storage."""
    landed = with_audit(
        raw.filter(F.col(event_time).isNotNull()),
        source=source,
        batch_id=batch_id if batch_id is not None else epoch_batch_id(""),
        as_string=True,
    ).withColumn("ingest_date", ingest_date())
    landed.write.mode("append").options(**PACKED).partitionBy("ingest_date").json(out_root)
    return landed


def file_inventory(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """One row per file under ``root`` (recursively): path, size, modification time.
    Reads file metadata only; an empty-array file is counted too."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
