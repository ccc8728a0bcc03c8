"""Explicit schemas for every layer (no schema inference anywhere).

Bronze leaves are all strings: the raw API text is kept as sent and typed once in silver
with ``try_*`` casts, so a dirty value becomes NULL instead of failing the job under ANSI.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


# Crash record fields the silver job keeps, in output order.
CRASH_FIELDS = (
    "crash_record_id",
    "crash_date",
    "weather_condition",
    "lighting_condition",
    "first_crash_type",
    "roadway_surface_cond",
    "latitude",
    "longitude",
    "injuries_total",
    "injuries_fatal",
)
AUDIT_FIELDS = ("ingestion_time", "source", "batch_id")

BRONZE_CRASH = StructType(_strings(*CRASH_FIELDS, *AUDIT_FIELDS))

# Video hits arrive in two shapes: flat (what the landing step writes) and nested (the
# search API's own item shape). One schema holds both; silver coalesces them.
BRONZE_VIDEO = StructType(
    _strings("video_id", "title", "channel", "published_at", "query", *AUDIT_FIELDS)
    + [
        StructField("id", StructType(_strings("videoId")), True),
        StructField("snippet", StructType(_strings("title", "channelTitle", "publishedAt")), True),
    ]
)

_AUDIT_TYPED = [
    StructField("ingestion_time", TimestampType(), True),
    StructField("source", StringType(), True),
    StructField("batch_id", StringType(), True),
]
_PARTS = [StructField("year", IntegerType(), True), StructField("month", IntegerType(), True)]

SILVER_CRASH = StructType(
    [
        StructField("crash_record_id", StringType(), True),
        StructField("crash_date", TimestampType(), True),
        StructField("weather_condition", StringType(), True),
        StructField("lighting_condition", StringType(), True),
        StructField("first_crash_type", StringType(), True),
        StructField("roadway_surface_cond", StringType(), True),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("injuries_total", DoubleType(), True),
        StructField("injuries_fatal", DoubleType(), True),
    ]
    + _AUDIT_TYPED
    + _PARTS
)

SILVER_VIDEO = StructType(
    [
        StructField("video_id", StringType(), True),
        StructField("title", StringType(), True),
        StructField("channel", StringType(), True),
        StructField("published_at", TimestampType(), True),
    ]
    + _AUDIT_TYPED
    + _PARTS
)

HOTSPOTS = StructType(
    [
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("accident_count", LongType(), False),
    ]
    + _PARTS
)

RISK_INDEX = StructType(
    [
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("accident_count", LongType(), False),
        StructField("bad_weather_count", LongType(), False),
        StructField("night_count", LongType(), False),
        StructField("risk_score", DoubleType(), True),
    ]
)

MONTHLY = StructType(
    [
        StructField("accident_count", LongType(), False),
        StructField("youtube_video_count", LongType(), True),
        StructField("videos_per_100_accidents", DoubleType(), True),
    ]
    + _AUDIT_TYPED
    + _PARTS
)

DIM_LOCATION = StructType(
    [
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("location_id", LongType(), False),
    ]
)

DIM_RISK = StructType(
    [
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("risk_score", DoubleType(), True),
        StructField("risk_id", LongType(), False),
    ]
)

FACT_ACCIDENTS = StructType(
    [
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("year", IntegerType(), True),
        StructField("month", IntegerType(), True),
        StructField("accident_count", LongType(), False),
        StructField("risk_score", DoubleType(), True),
        StructField("location_id", LongType(), False),
        StructField("risk_id", LongType(), False),
        StructField("fact_id", LongType(), False),
    ]
)

DIM_RISK_LEVEL = StructType(
    [
        StructField("risk_level", StringType(), True),
        StructField("min_score", DoubleType(), True),
        StructField("max_score_exclusive", DoubleType(), True),
        StructField("level_id", LongType(), True),
    ]
)

FACT_CRASHES = StructType(
    [
        StructField("crash_record_id", StringType(), True),
        StructField("crash_date", TimestampType(), True),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("location_id", LongType(), True),
        StructField("level_id", LongType(), True),
        StructField("risk_level", StringType(), True),
        StructField("injuries_total", DoubleType(), True),
        StructField("injuries_fatal", DoubleType(), True),
        *_strings("weather_condition", "lighting_condition", "first_crash_type"),
        *_PARTS,
    ]
)

TABLE_SCHEMAS = {
    "silver_crashes": SILVER_CRASH,
    "silver_videos": SILVER_VIDEO,
    "hotspots": HOTSPOTS,
    "risk_index": RISK_INDEX,
    "monthly": MONTHLY,
    "dim_location": DIM_LOCATION,
    "dim_risk": DIM_RISK,
    "fact_accidents": FACT_ACCIDENTS,
    "dim_risk_level": DIM_RISK_LEVEL,
    "fact_crashes": FACT_CRASHES,
}

# Tables of the daily load beside silver.
QUARANTINE = StructType(_strings("feed", "path", "record") + [StructField(c, LongType(), True) for c in ("n_rows", "n_read")])
LANDING_LOG = StructType(_strings("feed", "path") + [StructField("length", LongType(), True)])
KEY_INDEX = StructType([StructField("hash", LongType(), True), *_PARTS, StructField("bucket", IntegerType(), True)])
MONTH_COUNTS = StructType(_strings("feed") + _PARTS + [StructField("n", LongType(), True)])
RISK_COUNTS = StructType(
    [StructField(c, DoubleType(), True) for c in ("latitude", "longitude")]
    + [StructField(c, LongType(), True) for c in ("accident_count", "bad_weather_count", "night_count")]
)
