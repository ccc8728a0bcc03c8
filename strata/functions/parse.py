"""Type repair: ANSI-safe string → timestamp / number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _dtype(df: DataFrame | StructType, name: str):
    """Type of a top-level column. Pass a ``StructType`` fetched once when resolving many
    columns: ``DataFrame.schema`` is a round trip to the JVM on every access."""
    schema = df if isinstance(df, StructType) else df.schema
    return schema[name].dataType


def timestamp_of(df: DataFrame | StructType, name: str, fmt: str | None = None) -> Column:
    """``name`` as a timestamp; an unparseable string gives NULL (``try_to_timestamp``).

    Already-typed timestamps pass through unchanged, dates are widened.
    """
    c = F.col(name)
    t = _dtype(df, name)
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return c
    if isinstance(t, DateType):
        return c.cast("timestamp")
    if isinstance(t, StringType):
        return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return c.try_cast("timestamp")


def null_nan(c: Column) -> Column:
    """NaN → NULL, so a missing number is one thing (as pandas' to_numeric treats it)."""
    return F.nanvl(c, F.lit(None).cast("double"))


def double_of(df: DataFrame | StructType, name: str) -> Column:
    """``name`` as a double; text that is not a number gives NULL, NaN gives NULL."""
    c = F.col(name)
    t = _dtype(df, name)
    if isinstance(t, NumericType):
        return null_nan(c.cast("double"))
    return null_nan(F.when(c.rlike(_NUMBER), c.try_cast("double")))


# Plain decimal or exponent notation; the cast alone also takes a type suffix ("41.9d").
_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"


def int_of(c: Column) -> Column:
    """Nullable integer (pandas' Int64 repair)."""
    return c.try_cast("int")
