"""Deterministic surrogate keys.

``xxhash64`` of the natural key instead of ``monotonically_increasing_id``: the same row
gets the same id on every run and under any partitioning, and a fact row can compute its
dimension's id without joining the dimension. A namespace literal keeps ids of different
dimensions over the same natural key apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def surrogate_id(namespace: str, *cols: str | Column) -> Column:
    return F.xxhash64(F.lit(namespace), *[F.col(c) if isinstance(c, str) else c for c in cols])


def duplicate_ids(df: DataFrame, id_col: str, key_cols: list[str]) -> DataFrame:
    """Ids shared by more than one natural key (expected empty); a check, not a transform."""
    return (
        df.select(id_col, *key_cols)
        .distinct()
        .groupBy(id_col)
        .agg(F.count(F.lit(1)).alias("n_keys"))
        .filter(F.col("n_keys") > 1)
    )
