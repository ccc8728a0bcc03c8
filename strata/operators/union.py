"""Bag unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union matching columns by name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), list(frames))


def union_tagged(frames: Mapping[str, DataFrame], tag_col: str = "query") -> DataFrame:
    """Bag union of several result sets, each row tagged with the name of its set."""
    return union_by_name(df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items())
