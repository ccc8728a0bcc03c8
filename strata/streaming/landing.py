"""The landing log (S7, T1): which bronze files a lake has taken in.

The log is a table of file paths that is committed in the same lake version as the rows made of
these files. So a run that dies before its commit has taken nothing in, and the next one reads the
same files again; a run that dies after it is done. New files are those that the folder listing has
and the log has not: files that arrive late in an old folder are found too, and no clock or mark is
trusted. A file is known by path and length; one that was rewritten longer or shorter is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.bronze import file_inventory


def unlisted(spark: SparkSession, feed: str, root: str, log: DataFrame, glob: str = "*.json") -> DataFrame:
    """``path`` and ``length`` of the files below ``root`` that the log of ``feed`` lacks."""
    found = file_inventory(spark, root, glob).select("path", "length")
    seen = log.where(F.col("feed") == feed).select("path", "length")
    return found.join(seen, ["path", "length"], "left_anti")


def next_files(files: DataFrame, limit: int) -> list[tuple[str, int]]:
    """The first ``limit`` files by path: dated folders sort by day, so a backlog is worked off in order."""
    return [(r.path, r.length) for r in files.orderBy("path").limit(limit).collect()]
