"""Analytic queries behind the two dashboards (Q1-Q18), as DataFrame functions.

Each period query takes ``period=(year, month)`` to answer one selection (a filter on the
partition columns, so only that month's files are read), or ``period=None`` to answer every
period of the table in one pass, grouped by ``year, month``. Results are at most a few
hundred rows per period; nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.defaults import (
    MAP_BOX,
    PREVIEW_ROWS,
    TOP_CRASH_TYPE,
    TOP_HOTSPOTS,
    TOP_RISK,
    TOP_RISK_LABELS,
    TOP_SURFACE,
    TOP_WEATHER,
)
from strata.functions.labels import location_label, period_label, risk_level
from strata.operators.aggregate import count_by, frequency, rounded_mean, totals
from strata.operators.clean import in_box, in_period, require_not_null
from strata.operators.dedup import distinct_values
from strata.operators.rank import relative_to_max, top_k
from strata.operators.union import union_by_name
from strata.plans.gold import LOCATION

PERIOD = ("year", "month")
Period = tuple[int, int] | None


def _scope(df: DataFrame, period: Period) -> tuple[DataFrame, tuple[str, ...]]:
    if period is None:
        return df, tuple(c for c in PERIOD if c in df.columns)
    return in_period(df, *period), ()


def period_kpis(silver: DataFrame, period: Period = None) -> DataFrame:
    """Q1: crashes, injuries, fatalities, mappable rows."""
    df, group = _scope(silver, period)
    return totals(df, group)


def category_breakdown(silver: DataFrame, col: str, top: int | None, period: Period = None,
                       count_name: str = "crashes") -> DataFrame:
    """Q2-Q5: most frequent values of ``col`` (NULL excluded), descending, ties by value."""
    df, group = _scope(silver, period)
    return frequency(df, col, top=top, group=group, count_name=count_name)


def weather_breakdown(silver: DataFrame, period: Period = None, top: int = TOP_WEATHER) -> DataFrame:
    return category_breakdown(silver, "weather_condition", top, period)


def crash_type_breakdown(silver: DataFrame, period: Period = None, top: int = TOP_CRASH_TYPE) -> DataFrame:
    return category_breakdown(silver, "first_crash_type", top, period)


def surface_breakdown(silver: DataFrame, period: Period = None, top: int = TOP_SURFACE) -> DataFrame:
    return category_breakdown(silver, "roadway_surface_cond", top, period)


def lighting_breakdown(silver: DataFrame, period: Period = None) -> DataFrame:
    return category_breakdown(silver, "lighting_condition", None, period)


def hourly_profile(df: DataFrame, period: Period = None, ts: str = "crash_date") -> DataFrame:
    """Q6: crashes per hour of day (rows without a time excluded); order by ``hour``."""
    timed = require_not_null(df, ts)
    if "year" not in timed.columns:
        timed = timed.withColumns({"year": F.year(ts), "month": F.month(ts)})
    scoped, group = _scope(timed, period)
    counts = frequency(scoped.withColumn("hour", F.hour(ts)), "hour", group=group, count_name="crashes", by_key=True)
    return counts.orderBy(*group, "hour")


def map_points(silver: DataFrame, period: Period = None, box: tuple[float, float, float, float] = MAP_BOX,
               key: str | None = "crash_record_id") -> DataFrame:
    """Q7: points with both coordinates inside the inclusive bounding box; also used on a
    top-hotspot result (``key=None``) for the gold map."""
    df, group = _scope(silver, period)
    located = in_box(require_not_null(df, *LOCATION), box)
    return located.select(*group, *([key] if key else []), *LOCATION)


def _scored_top(counts: DataFrame, group: Sequence[str], k: int) -> DataFrame:
    ranked = top_k(counts, [F.col("accident_count").desc(), F.col("latitude").asc(), F.col("longitude").asc()], k,
                   partition_by=group, rank_col="rank")
    scored = ranked.withColumn("risk_score", relative_to_max("accident_count", group, 100.0, 1))
    return scored.withColumn("risk_level", risk_level(F.col("risk_score"))).select(
        *group, "rank", *LOCATION, "accident_count", "risk_score", "risk_level"
    )


def top_hotspots_from_crashes(silver: DataFrame, period: Period = None, k: int = TOP_HOTSPOTS) -> DataFrame:
    """Q8: top-``k`` locations by crashes in the period, scored against the period's top
    location (0-100, half-even at 1 place) with a level; rank 1 = most crashes."""
    df, group = _scope(silver, period)
    counts = count_by(require_not_null(df, *LOCATION), [*group, *LOCATION])
    return _scored_top(counts, group, k)


def top_hotspots(hotspots: DataFrame, period: Period = None, k: int = TOP_HOTSPOTS) -> DataFrame:
    """Q9: the same ranking read from the gold hotspot table."""
    df, group = _scope(hotspots, period)
    return _scored_top(df.select(*group, *LOCATION, "accident_count"), group, k)


def risk_kpis(risk: DataFrame) -> DataFrame:
    """Q10: number of locations, total crashes, mean risk score (2 places)."""
    return risk.agg(
        F.count(F.lit(1)).alias("total_locations"),
        F.coalesce(F.sum("accident_count"), F.lit(0)).cast("long").alias("total_accidents"),
        rounded_mean("risk_score", 2).alias("avg_risk_score"),
    )


def _risk_order() -> list:
    return [F.col("risk_score").desc_nulls_last(), F.col("latitude").asc(), F.col("longitude").asc()]


def top_risk(risk: DataFrame, k: int = TOP_RISK) -> DataFrame:
    """Q11: the ``k`` riskiest locations with a 1-based rank."""
    return top_k(risk, _risk_order(), k, rank_col="rank").select(
        "rank", *LOCATION, "accident_count", "bad_weather_count", "night_count", "risk_score"
    )


def risk_distribution(risk: DataFrame, k: int = TOP_RISK_LABELS) -> DataFrame:
    """Q12: the ``k`` riskiest locations labelled ``"lat,lon"`` (3 places)."""
    ranked = top_k(risk, _risk_order(), k, rank_col="rank")
    return ranked.select("rank", location_label(F.col("latitude"), F.col("longitude")).alias("location"),
                         "risk_score")


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Q13: crashes and videos per month with a ``"Jan 2024"`` label, in time order."""
    return monthly.select(
        "year", "month", period_label(F.col("year"), F.col("month")).alias("period"),
        "accident_count", "youtube_video_count",
    ).orderBy("year", "month")


def ratio_by_period(monthly: DataFrame) -> DataFrame:
    """Q14: videos per 100 crashes per labelled month, in time order."""
    return monthly.select(
        "year", "month", period_label(F.col("year"), F.col("month")).alias("period"), "videos_per_100_accidents"
    ).orderBy("year", "month")


def records_per_year(silver: DataFrame) -> DataFrame:
    """Q15: rows per year (rows without a year excluded), by year."""
    return frequency(silver, "year", count_name="records", by_key=True).orderBy("year")


def available_years(silver: DataFrame) -> DataFrame:
    """Q16: selectable years, newest first."""
    return distinct_values(require_not_null(silver, "year"), ["year"], descending=True)


def available_months_of(silver: DataFrame, year: int) -> DataFrame:
    """Q16: selectable months of one year, ascending (reads only that year's partitions)."""
    return distinct_values(require_not_null(in_period(silver, year), "month"), ["month"])


def available_periods(silver: DataFrame) -> DataFrame:
    """Q16: selectable (year, month) pairs; years descending, months ascending."""
    periods = require_not_null(silver, "year", "month").select("year", "month").distinct()
    return periods.orderBy(F.col("year").desc(), F.col("month").asc())


def layer_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Q17: rows per lake table, one row each (each a global count, no data moved); a
    missing table (``None``, as ``table_or_none`` gives) has NULL rows."""
    nothing = lambda: SparkSession.active().range(1).select(F.lit(None).cast("long").alias("rows"))
    return union_by_name(
        (nothing() if df is None else df.agg(F.count(F.lit(1)).alias("rows"))).select(F.lit(name).alias("layer"), "rows")
        for name, df in tables.items()
    )


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order: Sequence[str] = ("crash_record_id",)) -> DataFrame:
    """Q18: the first ``n`` rows in key order (a top-k, not a full sort)."""
    return df.orderBy(*[F.col(c).asc() for c in order]).limit(n)
