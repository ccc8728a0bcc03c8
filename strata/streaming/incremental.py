"""High-water-mark incremental load.

The mark is the latest event time already stored (a scalar subquery over the target), not
a side file, so it can never run ahead of what was written: it advances only when the
append commits. Candidates are rows at or after the mark (``strict=True`` gives the
original ``>`` cut, which skips rows sharing the mark's timestamp), plus rows without an
event time; candidates whose key is already stored are dropped. Insert-only: a later
version of a stored key is ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.aggregate import high_water_mark
from strata.operators.dedup import latest_per_key
from strata.operators.join import keys_absent_from
from strata.session import scratch_path
from strata.sources.lake import table_or_none, write_table


def incremental_delta(source: DataFrame, target: DataFrame | None, key: Sequence[str], ts: str = "crash_date",
                      strict: bool = False, lateness_seconds: int = 0, recent_only: bool = False,
                      dedup: bool = True, prefer: Sequence[str] = ("ingestion_time",)) -> DataFrame:
    """Rows of ``source`` to append to ``target`` (``None`` = empty target).

    ``lateness_seconds`` widens the cut to ``mark - lateness`` for late arrivals.
    ``recent_only`` compares keys only with stored rows at or after that cut (and rows
    without a time); it is exact when a key's event time never changes. If ``target`` has the
    columns ``year`` and ``month`` of ``ts``, the months before the cut are left out too, which
    on a table partitioned by them prunes the key scan to the newest partitions.
    """
    key = list(key)
    for c in key:  # a row without a key can't be told from a stored one
        source = source.filter(F.col(c).isNotNull())
    if target is None:
        cand = source
    else:
        mark = high_water_mark(target, ts)
        lower = mark - F.make_dt_interval(secs=F.lit(lateness_seconds)) if lateness_seconds else mark
        newer = F.col(ts) > lower if strict else F.col(ts) >= lower
        # an empty target has a NULL mark: the comparison is NULL and everything is new
        cand = source.filter(F.col(ts).isNull() | F.coalesce(newer, F.lit(True)))
    if dedup:
        cand = latest_per_key(cand, key, prefer=[c for c in prefer if c in cand.columns])
    if target is None:
        return cand
    stored = target
    if recent_only:
        stored = target.filter(F.col(ts).isNull() | (F.col(ts) >= lower))
        if {"year", "month"} <= set(target.columns):
            month = F.col("year") * 12 + F.col("month")
            stored = stored.filter(month.isNull() | (month >= F.year(lower) * 12 + F.month(lower)))
    return keys_absent_from(cand, stored, key)


def incremental_load(spark: SparkSession, source: DataFrame, target_path: str, schema: StructType,
                     key: Sequence[str], ts: str = "crash_date", partition_by: Sequence[str] = ("year", "month"),
                     **kwargs) -> DataFrame:
    """Append the delta of ``source`` to the Parquet table at ``target_path`` (created
    when missing) and return it. The delta is computed once, into the shared scratch folder, and both
    the append and the returned frame read it there. The target is only appended to, never
    overwritten while it is being read."""
    target = table_or_none(spark, target_path, schema)
    delta = incremental_delta(source, target, key, ts, **kwargs).select(*schema.fieldNames())
    path = scratch_path(spark, "delta")
    write_table(delta, path)
    delta = spark.read.schema(delta.schema).parquet(path)
    write_table(delta, target_path, partition_by, mode="append")
    return delta
