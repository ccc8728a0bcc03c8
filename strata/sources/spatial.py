"""Spatial layout (P8, Q7): rows that are near each other share files and row groups.

Two coordinates are brought to integers of ``BITS`` bits over the table's own range, and their bits are interleaved (a
Z-order curve). Rows are range-partitioned and sorted by the curve before the write, so the minima and maxima that
Parquet keeps of both columns are narrow in every row group, and a box filter skips the groups it can't meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16
#: Bytes of a row group: small, so that a box skips more of them.
GROUP_BYTES = 8 << 20


def _spread(c: Column) -> Column:
    """Bits of a 16-bit integer moved to the even places."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return c


def z_order(cells: Sequence[Column]) -> Column:
    """The place of a cell on the curve; null where a coordinate is."""
    low, high = (_spread(c.cast("long")) for c in cells)
    return low.bitwiseOR(F.shiftleft(high, 1))


def cells_of(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column as an integer of ``BITS`` bits over the range of its finite values."""
    finite = {c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in columns}
    ends = df.agg(*[f(finite[c]).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = []
    for c in columns:
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        width = (hi - lo) if lo is not None and hi > lo else 1.0
        out.append(F.floor((F.greatest(F.lit(0.0), F.least(F.lit(1.0), (finite[c] - F.lit(lo)) / F.lit(width)))) * ((1 << BITS) - 1)))
    return out


def write_clustered(df: DataFrame, path: str, columns: Sequence[str] = ("latitude", "longitude"), mode: str = "overwrite",
                    group_bytes: int = GROUP_BYTES) -> None:
    """Write ``df`` in the order of the curve over two columns; rows without a place on it come first."""
    curve = z_order(cells_of(df, columns))
    rows = df.withColumn("_z", curve)
    rows = rows.repartitionByRange(F.col("_z").asc_nulls_first()).sortWithinPartitions(F.col("_z").asc_nulls_first()).drop("_z")
    rows.write.mode(mode).option("parquet.block.size", group_bytes).parquet(path)
