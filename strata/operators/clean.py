"""Row filters and projections."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``cols`` (P5)."""
    return df.dropna(how="any", subset=list(cols))


def require_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """NOT NULL conjunction (P6); pushed to the Parquet scan as ``IsNotNull``."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def in_period(df: DataFrame, year: int, month: int | None = None, year_col: str = "year",
              month_col: str = "month") -> DataFrame:
    """Period selection (P7); on a year/month-partitioned table it prunes partitions."""
    cond = F.col(year_col) == F.lit(year)
    if month is not None:
        cond = cond & (F.col(month_col) == F.lit(month))
    return df.filter(cond)


def in_box(df: DataFrame, box: tuple[float, float, float, float], lat: str = "latitude",
           lon: str = "longitude") -> DataFrame:
    """Inclusive bounding box (P8); NULL coordinates never match."""
    lat_lo, lat_hi, lon_lo, lon_hi = box
    return df.filter(F.col(lat).between(lat_lo, lat_hi) & F.col(lon).between(lon_lo, lon_hi))


def is_one_of(c: Column, values: Iterable[str]) -> Column:
    """Exact-string membership (P9); NULL stays NULL, so it is never counted (P10)."""
    return c.isin(list(values))


def col_or_null(df: DataFrame | StructType, path: str, dtype: DataType = StringType()) -> Column:
    """A (possibly nested) column if the frame has it, else a typed NULL."""
    return F.col(path).cast(dtype) if has_path(df, path) else F.lit(None).cast(dtype)


def has_path(df: DataFrame | StructType, path: str) -> bool:
    schema = df if isinstance(df, StructType) else df.schema
    head, *rest = path.split(".")
    if head not in schema.fieldNames():
        return False
    t = schema[head].dataType
    for part in rest:
        if not isinstance(t, StructType) or part not in t.fieldNames():
            return False
        t = t[part].dataType
    return True


def first_present(df: DataFrame | StructType, *paths: str, dtype: DataType | None = None) -> Column:
    """Flatten alternatives: the first non-NULL of nested / flat spellings.

    Spellings the frame lacks are skipped; a single present one keeps its own type unless
    ``dtype`` is given; several are coalesced as ``dtype`` (string by default).
    """
    schema = df if isinstance(df, StructType) else df.schema
    present = [p for p in paths if has_path(schema, p)]
    if not present:
        return F.lit(None).cast(dtype or StringType())
    if len(present) == 1:
        c = F.col(present[0])
        return c.cast(dtype) if dtype is not None else c
    return F.coalesce(*[F.col(p).cast(dtype or StringType()) for p in present])


def with_period(df: DataFrame, ts: str, year_col: str = "year", month_col: str = "month") -> DataFrame:
    """Repair ``year`` / ``month`` as nullable ints, deriving them from ``ts`` where the
    frame lacks them or holds a value that is not a number."""
    columns = df.columns

    def repaired(name: str, derive) -> Column:
        derived = derive(F.col(ts))
        if name not in columns:
            return derived
        return F.coalesce(F.col(name).try_cast("int"), derived)

    return df.withColumns({year_col: repaired(year_col, F.year), month_col: repaired(month_col, F.month)})
