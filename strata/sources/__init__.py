"""Sources and sinks: bronze JSON and Parquet lake tables."""

from strata.sources.bronze import (
    file_inventory,
    land_bronze,
    read_bronze_crashes,
    read_bronze_videos,
    read_json,
)
from strata.sources.lake import (
    MissingTable,
    cached,
    console,
    cut_lineage,
    read_table,
    read_table_files,
    table_or_none,
    write_table,
)

__all__ = [
    "MissingTable",
    "cached",
    "console",
    "cut_lineage",
    "file_inventory",
    "land_bronze",
    "read_bronze_crashes",
    "read_bronze_videos",
    "read_json",
    "read_table",
    "read_table_files",
    "table_or_none",
    "write_table",
]
