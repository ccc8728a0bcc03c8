"""Display labels as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.defaults import LEVEL_HIGH, LEVEL_MEDIUM, LEVEL_NAMES, MONTH_ABBR


def month_abbr(month: Column) -> Column:
    """1..12 → Jan..Dec; anything else → NULL."""
    expr = None
    for i, name in enumerate(MONTH_ABBR, start=1):
        expr = F.when(month == i, F.lit(name)) if expr is None else expr.when(month == i, F.lit(name))
    return expr


def period_label(year: Column, month: Column) -> Column:
    """``"Jan 2024"``; an unknown month gives ``" 2024"`` as the dashboard does."""
    return F.concat(F.coalesce(month_abbr(month), F.lit("")), F.lit(" "), year.cast("string"))


def location_label(lat: Column, lon: Column, digits: int = 3) -> Column:
    """``"41.9,-87.6"`` at ``digits`` places (half-even), ``"unknown"`` without a latitude."""
    fmt = lambda c: F.coalesce(F.bround(c, digits).cast("string"), F.lit("nan"))
    return F.when(lat.isNotNull(), F.concat(fmt(lat), F.lit(","), fmt(lon))).otherwise(F.lit("unknown"))


def risk_level(score: Column, high: float = LEVEL_HIGH, medium: float = LEVEL_MEDIUM) -> Column:
    """Three-way level; a NULL score is ``Low`` (no threshold is met)."""
    hi, mid, lo = LEVEL_NAMES
    return F.when(score >= high, F.lit(hi)).when(score >= medium, F.lit(mid)).otherwise(F.lit(lo))
