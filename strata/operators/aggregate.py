"""Aggregations (A1-A11). All are single-pass hash aggregates with a partial step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rank import top_k


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "accident_count") -> DataFrame:
    """Row count per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def counts_with_conditions(df: DataFrame, keys: Sequence[str | Column], conditions: Mapping[str, Column],
                           total: str = "accident_count") -> DataFrame:
    """Row count plus one conditional count per predicate, in one pass (A2).

    A predicate that is NULL is not counted (``count_if`` == ``count(when(p, true))``).
    """
    aggs = [F.count(F.lit(1)).alias(total)] + [F.count_if(p).alias(n) for n, p in conditions.items()]
    return df.groupBy(*keys).agg(*aggs)


def frequency(df: DataFrame, col: str, top: int | None = None, group: Sequence[str] = (),
              count_name: str = "count", by_key: bool = False) -> DataFrame:
    """Frequency table of ``col`` without NULLs (A4), per ``group``.

    ``top`` keeps the ``top`` most frequent values per group, ties by value ascending; the
    per-group cut is pushed before the shuffle as a partial window-group limit. The result is
    ordered by group, falling count and value. ``by_key`` (A5) keeps all values; callers order
    by the value.
    """
    counted = df.filter(F.col(col).isNotNull()).groupBy(*group, col).agg(F.count(F.lit(1)).alias(count_name))
    if by_key:
        return counted
    order = [F.col(count_name).desc(), F.col(col).asc()]
    if top is not None:
        counted = top_k(counted, order, top, partition_by=group)
    return counted.orderBy(*group, *order)


def totals(df: DataFrame, group: Sequence[str] = (), injuries: str = "injuries_total",
           fatal: str = "injuries_fatal", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Period KPIs (A6, A7): rows, injuries, fatalities (sums truncated to integers, 0
    when there is nothing to sum) and rows with both coordinates."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_crashes"),
        F.coalesce(F.sum(injuries), F.lit(0.0)).cast("long").alias("total_injuries"),
        F.coalesce(F.sum(fatal), F.lit(0.0)).cast("long").alias("total_fatalities"),
        F.count_if(F.col(lat).isNotNull() & F.col(lon).isNotNull()).alias("mappable"),
    )


def rounded_mean(c: str, digits: int = 2) -> Column:
    """Mean with missing values skipped, rounded half-up to ``digits`` places.

    For values that carry at most ``digits`` decimals (scores rounded to 2 places) the mean
    is computed exactly: values are summed as integer units of ``10**-digits`` and the
    rounding is integer arithmetic, so a mean that lies exactly on a half is rounded the
    same way regardless of summation order or engine. NULL when there is no value.
    """
    scale = 10**digits
    units = F.sum(F.round(F.col(c) * F.lit(scale)).cast("long"))
    n = F.count(c)
    up = F.when(n > 0, F.call_function("div", units * 2 + n, n * 2))
    down = F.when(n > 0, -F.call_function("div", -units * 2 + n, n * 2))
    return F.try_divide(F.when(units >= 0, up).otherwise(down), F.lit(scale))


def high_water_mark(df: DataFrame, ts: str) -> Column:
    """The latest event time of ``df`` as a scalar subquery (A10); NULL when empty."""
    return df.agg(F.max(ts)).scalar()
