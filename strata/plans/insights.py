"""Findings the write-up states without code (X1-X4, X7), as plain aggregate queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.aggregate import count_by
from strata.operators.clean import require_not_null
from strata.operators.join import join_on
from strata.plans.gold import LOCATION, monthly_counts


def _month_index(df: DataFrame) -> DataFrame:
    return df.withColumn("month_index", F.col("year") * 12 + F.col("month") - 1)


def crash_video_correlation(crashes: DataFrame, videos: DataFrame, digits: int = 6) -> DataFrame:
    """Pearson correlation of monthly crashes with monthly videos, same month and
    videos of the following month (months without videos count 0; NULL periods left out).
    One row; inputs are monthly aggregates (one row per month)."""
    cm = require_not_null(monthly_counts(crashes, "crash_record_id", "crash_date", "accident_count"), "year", "month")
    vm = require_not_null(monthly_counts(videos, "video_id", "published_at", "youtube_video_count"), "year", "month")
    same = join_on(cm, vm, ["year", "month"], "left")
    nxt = _month_index(vm).select((F.col("month_index") - 1).alias("month_index"),
                                  F.col("youtube_video_count").alias("next_month_videos"))
    both = join_on(_month_index(same), nxt, ["month_index"], "left")
    both = both.fillna(0, subset=["youtube_video_count", "next_month_videos"])
    return both.agg(
        F.count(F.lit(1)).alias("months"),
        F.round(F.corr("accident_count", "youtube_video_count"), digits).alias("corr_same_month"),
        F.round(F.corr("accident_count", "next_month_videos"), digits).alias("corr_next_month"),
    )


def fatality_rate(silver: DataFrame, by: str = "lighting_condition", digits: int = 6) -> DataFrame:
    """Fatalities per crash for each value of ``by`` (NULL values left out)."""
    return require_not_null(silver, by).groupBy(by).agg(
        F.count(F.lit(1)).alias("crashes"),
        F.coalesce(F.sum("injuries_fatal"), F.lit(0.0)).alias("fatalities"),
        F.round(F.coalesce(F.sum("injuries_fatal"), F.lit(0.0)) / F.count(F.lit(1)), digits).alias("fatality_rate"),
    )


def persistent_hotspots(hotspots: DataFrame, min_years: int = 2) -> DataFrame:
    """Locations with crashes in at least ``min_years`` distinct years."""
    per_loc = hotspots.groupBy(*LOCATION).agg(
        F.countDistinct("year").alias("years_active"),
        F.sum("accident_count").alias("accident_count"),
    )
    return per_loc.filter(F.col("years_active") >= min_years)


def year_over_year(silver: DataFrame) -> DataFrame:
    """Crashes per year, change against the previous calendar year (NULL when that
    year has no rows) and the peak year (most crashes; ties → the later year).

    The window runs over the per-year aggregate, which has at most one row per calendar
    year (a bound that does not grow with the data), so it is computed once and in one
    pass; ``lag`` is only used when the previous row really is ``year - 1``.
    """
    per_year = count_by(require_not_null(silver, "year"), ["year"], "records")
    by_year = Window.orderBy("year")
    everything = Window.partitionBy()
    prev_year = F.lag("year").over(by_year)
    prev = F.when(prev_year == F.col("year") - 1, F.lag("records").over(by_year))
    peak = F.max(F.struct("records", "year")).over(everything)["year"]
    out = per_year.select("year", "records", prev.alias("prev_records"), (F.col("year") == peak).alias("is_peak"))
    return out.select(
        "year", "records", "prev_records",
        (F.col("records") - F.col("prev_records")).alias("change"),
        F.round((F.col("records") - F.col("prev_records")) / F.col("prev_records") * 100, 2).alias("pct_change"),
        "is_peak",
    )


def grid_bins(silver: DataFrame, cell: float = 0.01) -> DataFrame:
    """Crashes per square grid cell of ``cell`` degrees (cell index = floor(coord / cell))."""
    located = require_not_null(silver, *LOCATION)
    return count_by(
        located,
        [F.floor(F.col("latitude") / F.lit(cell)).alias("lat_bin"), F.floor(F.col("longitude") / F.lit(cell)).alias("lon_bin")],
        "crashes",
    )
