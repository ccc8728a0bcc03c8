"""Warehouse (G6, G7, G8) and the per-crash star form.

Surrogate ids are hashes of the natural key (see ``strata.functions.ids``), so the fact
computes ``location_id`` / ``risk_id`` from its own columns and no dimension has to be
joined to resolve them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.defaults import LEVEL_HIGH, LEVEL_MEDIUM, LEVEL_NAMES
from strata.functions.ids import surrogate_id
from strata.operators.clean import require_not_null
from strata.operators.dedup import distinct_rows
from strata.operators.join import join_on
from strata.plans.gold import LOCATION, normalised_risk


def location_id(*cols: str) -> F.Column:
    return surrogate_id("location", *(cols or LOCATION))


def risk_id(*cols: str) -> F.Column:
    return surrogate_id("risk", *(cols or LOCATION))


def dim_location(hotspots: DataFrame) -> DataFrame:
    """Distinct locations of the hotspot table with their id."""
    return distinct_rows(hotspots, list(LOCATION)).withColumn("location_id", location_id())


def dim_risk(risk: DataFrame) -> DataFrame:
    """One row per location with its weighted score and id."""
    return risk.select(*LOCATION, "risk_score").withColumn("risk_id", risk_id())


def fact_accidents(hotspots: DataFrame, risk: DataFrame) -> DataFrame:
    """Hotspot grain (location × month) ⋈ risk score per location (n:1, inner).

    Both sides derive from the same silver table, so every hotspot finds its location.
    A location holds at most one row per month on the left, so the join key is not skewed.
    """
    joined = join_on(hotspots, risk.select(*LOCATION, "risk_score"), list(LOCATION), "inner")
    return joined.select(
        *LOCATION, "year", "month", "accident_count", "risk_score",
        location_id().alias("location_id"),
        risk_id().alias("risk_id"),
        surrogate_id("fact", *LOCATION, "year", "month").alias("fact_id"),
    )


def level_id(level: str = "risk_level") -> F.Column:
    return surrogate_id("level", level)


def risk_level_dim(spark: SparkSession) -> DataFrame:
    """X6 dimension: the three risk levels with their key and score bounds (static, 3 rows)."""
    hi, mid, lo = LEVEL_NAMES
    rows = [(hi, LEVEL_HIGH, None), (mid, LEVEL_MEDIUM, LEVEL_HIGH), (lo, None, LEVEL_MEDIUM)]
    return spark.createDataFrame(rows, "risk_level string, min_score double, max_score_exclusive double").withColumn(
        "level_id", level_id())


def star_fact(silver: DataFrame, risk: DataFrame) -> DataFrame:
    """One fact row per crash with its location key, the location's all-time risk
    level and its key, injuries, weather and crash type.

    The level table has one row per location; AQE broadcasts it when small, otherwise the
    sort-merge join splits a location that holds a large share of all crashes.
    """
    levels = normalised_risk(risk).select(*LOCATION, "risk_level")
    crashes = require_not_null(silver, *LOCATION)
    joined = join_on(crashes, levels, list(LOCATION), "left")
    return joined.select(
        "crash_record_id", "crash_date", "year", "month", *LOCATION,
        location_id().alias("location_id"), level_id().alias("level_id"), "risk_level",
        "injuries_total", "injuries_fatal", "weather_condition", "lighting_condition", "first_crash_type",
    )
