"""A scan that says what it skipped (S4): the rows of all readable row groups, and a report for every file.

Spark's own ``ignoreCorruptFiles`` drops what it can't read without a word. Here each file is one record of
a distributed read of the folder and is opened in the task that got it. A file whose footer can't be read gives no
row and its error; a row group with a bad page gives no row, and its rows count as lost. Missing columns are null,
others are ignored; partition folders are not parsed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.session import scratch_path

REPORT = StructType([StructField("path", StringType()), StructField("length", LongType()), StructField("rows_read", LongType()),
                     StructField("rows_lost", LongType()), StructField("error", StringType())])


def read_reporting(spark: SparkSession, path: str, schema: StructType, glob: str = "*.parquet") -> tuple[DataFrame, DataFrame]:
    """Rows and report of the Parquet files below ``path``; ``rows_lost`` is null where the footer can't tell.

    The files are read once, and both results are written to the shared scratch folder. A task holds one file at a
    time.
    """
    full = StructType([StructField("_report", REPORT), StructField("_row", schema)])
    target = to_arrow_schema(full)
    report_kind, row_kind = target.field("_report").type, target.field("_row").type

    def fit(table: pa.Table) -> pa.StructArray:
        columns = []
        for f in row_kind:
            at = table.schema.get_field_index(f.name)
            columns.append(pa.nulls(table.num_rows, f.type) if at < 0 else table.column(at).combine_chunks().cast(f.type))
        return pa.StructArray.from_arrays(columns, fields=list(row_kind))

    def out(rows: pa.StructArray | None, report: dict | None) -> pa.RecordBatch:
        n = 1 if report else len(rows)
        return pa.RecordBatch.from_arrays([pa.array([report], report_kind) if report else pa.nulls(n, report_kind),
                                           pa.nulls(n, row_kind) if report else rows], schema=target)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                report = {"path": batch.column("path")[i].as_py(), "length": batch.column("length")[i].as_py(),
                          "rows_read": 0, "rows_lost": None, "error": None}
                try:
                    file = pq.ParquetFile(pa.BufferReader(batch.column("content")[i].as_buffer()))
                    report["rows_lost"] = 0
                    for g in range(file.num_row_groups):
                        n = file.metadata.row_group(g).num_rows
                        try:
                            rows = fit(file.read_row_group(g))
                        except (pa.ArrowException, OSError, ValueError) as exc:
                            report["rows_lost"] += n
                            report["error"] = report["error"] or f"{type(exc).__name__}: {str(exc)[:300]}"
                        else:
                            report["rows_read"] += n
                            yield out(rows, None)
                except (pa.ArrowException, OSError, ValueError) as exc:
                    report["error"] = f"{type(exc).__name__}: {str(exc)[:300]}"
                yield out(None, report)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    written = scratch_path(spark, "scan-report")
    bound = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # one file a batch; for this write alone
    try:
        files.select("path", "length", "content").mapInArrow(parse, full).write.parquet(written)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", bound)
    both = spark.read.schema(full).parquet(written)
    rows = both.where("_row is not null").select(*[F.col(f"_row.`{c}`").alias(c) for c in schema.fieldNames()])
    return rows, both.where("_report is not null").select("_report.*")
