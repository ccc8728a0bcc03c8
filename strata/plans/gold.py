"""Gold layer (G3, G4, G5) and the normalised risk form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.defaults import BAD_WEATHER, NIGHT_LIGHTING, RISK_WEIGHTS, SOURCE_GOLD_MONTHLY
from strata.functions.audit import with_audit
from strata.functions.labels import risk_level
from strata.operators.aggregate import count_by, counts_with_conditions
from strata.operators.clean import is_one_of, require_not_null
from strata.operators.join import join_on
from strata.operators.rank import relative_to_table_max

LOCATION = ("latitude", "longitude")


def hotspots(silver: DataFrame) -> DataFrame:
    """Crashes per (latitude, longitude, year, month)."""
    located = require_not_null(silver, *LOCATION)
    return count_by(located, [*LOCATION, "year", "month"]).select(*LOCATION, "accident_count", "year", "month")


def risk_index(silver: DataFrame, bad_weather: Sequence[str] = BAD_WEATHER, night: Sequence[str] = NIGHT_LIGHTING,
               weights: tuple[float, float, float] = RISK_WEIGHTS, weather_col: str = "weather_condition",
               lighting_col: str = "lighting_condition") -> DataFrame:
    """Per location, all time: crashes, bad-weather crashes, night crashes and
    ``round(w0*crashes + w1*bad + w2*night, 2)`` (unbounded weighted sum)."""
    located = require_not_null(silver, *LOCATION)
    counted = counts_with_conditions(
        located,
        list(LOCATION),
        {
            "bad_weather_count": is_one_of(F.col(weather_col), bad_weather),
            "night_count": is_one_of(F.col(lighting_col), night),
        },
    )
    return scored(counted, weights)


def scored(counts: DataFrame, weights: tuple[float, float, float] = RISK_WEIGHTS) -> DataFrame:
    """The weighted ``risk_score`` of per-location counts."""
    w_n, w_b, w_l = weights
    score = F.round(
        F.col("accident_count") * F.lit(w_n) + F.col("bad_weather_count") * F.lit(w_b)
        + F.col("night_count") * F.lit(w_l),
        2,
    )
    return counts.withColumn("risk_score", score)


def monthly_counts(df: DataFrame, key: str, ts: str, name: str) -> DataFrame:
    """Rows per calendar month of ``ts`` (A3), rows without ``key`` excluded."""
    valid = require_not_null(df, key)
    return count_by(valid, [F.year(ts).alias("year"), F.month(ts).alias("month")], name)


def monthly(crashes: DataFrame, videos: DataFrame, source: str = SOURCE_GOLD_MONTHLY,
            batch_id: str | None = None) -> DataFrame:
    """Crash months ⟕ video months. Video-only months drop out; a month without
    videos has 0; ``videos_per_100_accidents = round(videos / crashes * 100, 2)``.

    Both sides are aggregates (one row per month); AQE broadcasts the video side at runtime
    when it is small, which it is for any realistic span of months.
    """
    cm = monthly_counts(crashes, "crash_record_id", "crash_date", "accident_count")
    vm = monthly_counts(videos, "video_id", "published_at", "youtube_video_count")
    return monthly_table(cm, vm, source, batch_id)


def monthly_table(cm: DataFrame, vm: DataFrame, source: str = SOURCE_GOLD_MONTHLY, batch_id: str | None = None) -> DataFrame:
    """Crash months ⟕ video months from their counts."""
    joined = join_on(cm, vm, ["year", "month"], "left")
    joined = joined.withColumn("youtube_video_count", F.coalesce(F.col("youtube_video_count"), F.lit(0).cast("long")))
    joined = joined.withColumn(
        "videos_per_100_accidents", F.round(F.col("youtube_video_count") / F.col("accident_count") * F.lit(100), 2)
    )
    out = with_audit(joined, source=source, batch_id=batch_id)
    return out.select("year", "month", "accident_count", "youtube_video_count", "videos_per_100_accidents",
                      "ingestion_time", "source", "batch_id")


def normalised_risk(risk: DataFrame, value: str = "accident_count", digits: int = 1) -> DataFrame:
    """All-time 0-100 score ``value / max(value) * 100`` with a High / Medium / Low
    level. The maximum is a scalar subquery, not a window over the whole table."""
    score = relative_to_table_max(risk, value, 100.0, digits)
    return risk.select(*LOCATION, value, score.alias("normalised_score")).withColumn(
        "risk_level", risk_level(F.col("normalised_score"))
    )
