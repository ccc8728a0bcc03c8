"""Top-k, rank and relative scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

#: Catalyst's default bound of a window-group limit, and the parts of a group beyond it.
GROUP_LIMIT = 1000
SALTS = 64


def top_k(df: DataFrame, order: Sequence[Column], k: int, partition_by: Sequence[str] = (),
          rank_col: str | None = None) -> DataFrame:
    """The first ``k`` rows per partition group under a total ``order`` (O2), with an
    optional 1-based rank (W1).

    Without groups this is an ordered limit (a top-k per task, then of these) for every
    ``k``, and the rank is taken over the ``k`` rows. With groups it is ``row_number() <= k``:
    up to ``GROUP_LIMIT`` Catalyst cuts each group before the shuffle. Beyond it, groups are
    first cut to ``k`` rows in each of ``SALTS`` parts, so no task sorts a whole hot group.
    """
    if not partition_by:
        out = df.orderBy(*order).limit(k)
        return out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order))) if rank_col else out
    if k > GROUP_LIMIT:
        hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(SALTS)))
        part = Window.partitionBy(*partition_by, "_salt").orderBy(*order)
        df = df.withColumn("_pn", F.row_number().over(part)).filter(F.col("_pn") <= k).drop("_pn", "_salt")
    w = Window.partitionBy(*partition_by).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def relative_to_max(value: str, partition_by: Sequence[str] = (), scale: float = 100.0, digits: int = 1) -> Column:
    """``value / max(value) * scale`` within the group, rounded half-even.

    A window: use it only on a bounded input, i.e. after ``top_k`` (at most ``k`` rows per
    group). For an unbounded table use ``relative_to_table_max``.
    """
    w = Window.partitionBy(*partition_by)
    return F.bround(F.col(value) / F.max(value).over(w) * F.lit(scale), digits)


def relative_to_table_max(df: DataFrame, value: str, scale: float = 100.0, digits: int = 1) -> Column:
    """``value / max(value over the whole table) * scale``; the maximum is a scalar
    subquery (one small job), so nothing is moved into a single partition."""
    mx = df.agg(F.max(value)).scalar()
    return F.bround(F.col(value) / mx * F.lit(scale), digits)


def newest(df: DataFrame, ts: str, n: int, key: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows by ``ts`` (S8, O4); ties by ``key`` ascending. A top-k
    (TakeOrderedAndProject), not a full sort."""
    return df.orderBy(F.col(ts).desc_nulls_last(), *[F.col(c).asc() for c in key]).limit(n)


def next_page(df: DataFrame, ts: str, n: int, after=None, key: Sequence[str] = ()) -> DataFrame:
    """The ``n`` oldest rows strictly after ``after`` (a timestamp literal or column),
    ordered by ``ts`` then ``key``: the page an ordered, limited source read returns."""
    rows = df if after is None else df.filter(F.col(ts) > (after if isinstance(after, Column) else F.lit(after)))
    return rows.orderBy(F.col(ts).asc_nulls_last(), *[F.col(c).asc() for c in key]).limit(n)
