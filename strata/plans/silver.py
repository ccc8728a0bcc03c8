"""Silver layer (G1, G2): typed, de-duplicated, partition-ready records.

Order of steps is part of the semantics: NULL key / NULL event-time rows are dropped on the
raw text, then one row per key is kept, and only then are rows without coordinates removed
(a key whose surviving version lacks coordinates disappears, as in the original job). A
date that does not parse is kept with a NULL timestamp (it lands in the default partition)
unless ``drop_unparsed`` is set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.defaults import SILVER_BATCH_ID, SOURCE_SILVER_CRASH, SOURCE_SILVER_VIDEO
from strata.functions.audit import audit_columns
from strata.functions.parse import double_of, timestamp_of
from strata.operators.clean import drop_null, first_present, require_not_null
from strata.operators.dedup import latest_per_key
from strata.schemas import CRASH_FIELDS

_TEXT = ("crash_record_id", "weather_condition", "lighting_condition", "first_crash_type", "roadway_surface_cond")
_NUMBERS = ("latitude", "longitude", "injuries_total", "injuries_fatal")


def _ingested(schema: StructType) -> list[F.Column]:
    """Bronze ingestion time as a timestamp ``_ingested``, the first survivor criterion;
    nothing when the input has no ingestion time (then the other columns decide)."""
    if "ingestion_time" in schema.fieldNames():
        return [timestamp_of(schema, "ingestion_time").alias("_ingested")]
    return []


def _raw_crashes(bronze: DataFrame) -> DataFrame:
    """One raw row per key: NULL keys and event times dropped, then the latest version (G1)."""
    schema = bronze.schema
    raw = bronze.select(*[first_present(schema, c).alias(c) for c in CRASH_FIELDS], *_ingested(schema))
    raw = drop_null(raw, ["crash_record_id", "crash_date"])
    return latest_per_key(raw, ["crash_record_id"], prefer=["_ingested"])


def _typed_crashes(one: DataFrame, source: str, batch_id: str, drop_unparsed: bool) -> DataFrame:
    one_schema = one.schema
    typed = {c: F.col(c).cast("string") for c in _TEXT}
    typed.update({c: double_of(one_schema, c) for c in _NUMBERS})
    typed["crash_date"] = timestamp_of(one_schema, "crash_date")
    keep = typed["latitude"].isNotNull() & typed["longitude"].isNotNull()
    if drop_unparsed:
        keep = keep & typed["crash_date"].isNotNull()
    audit = audit_columns(source=source, batch_id=batch_id)
    return one.filter(keep).select(
        *[typed[c].alias(c) for c in CRASH_FIELDS],
        *[v.alias(k) for k, v in audit.items()],
        F.year(typed["crash_date"]).alias("year"),
        F.month(typed["crash_date"]).alias("month"),
    )


def silver_crashes(bronze: DataFrame, source: str = SOURCE_SILVER_CRASH, batch_id: str = SILVER_BATCH_ID,
                   drop_unparsed: bool = False) -> DataFrame:
    """G1: bronze crash records → silver (schema ``SILVER_CRASH``)."""
    return _typed_crashes(_raw_crashes(bronze), source, batch_id, drop_unparsed)


def crash_survivors(bronze: DataFrame) -> DataFrame:
    """The raw survivor of each key with the month of its event time: what an incremental load keeps."""
    one = _raw_crashes(bronze)
    time = timestamp_of(one.schema, "crash_date")
    return one.withColumns({"year": F.year(time), "month": F.month(time)})


def crashes_of(survivors: DataFrame) -> DataFrame:
    """Silver rows of raw survivors, row by row."""
    return _typed_crashes(survivors, SOURCE_SILVER_CRASH, SILVER_BATCH_ID, False)


def _raw_videos(bronze: DataFrame) -> DataFrame:
    schema = bronze.schema
    flat = bronze.select(
        first_present(schema, "id.videoId", "video_id", dtype=None).cast("string").alias("video_id"),
        first_present(schema, "snippet.title", "title").cast("string").alias("title"),
        first_present(schema, "snippet.channelTitle", "channel").cast("string").alias("channel"),
        first_present(schema, "snippet.publishedAt", "published_at").alias("published_at"),
        *_ingested(schema),
    )
    flat = require_not_null(flat, "video_id")
    return latest_per_key(flat, ["video_id"], prefer=["_ingested"])


def _typed_videos(one: DataFrame, source: str, batch_id: str) -> DataFrame:
    published = timestamp_of(one, "published_at")
    audit = audit_columns(source=source, batch_id=batch_id)
    return one.select(
        "video_id", "title", "channel", published.alias("published_at"),
        *[v.alias(k) for k, v in audit.items()],
        F.year(published).alias("year"), F.month(published).alias("month"),
    )


def silver_videos(bronze: DataFrame, source: str = SOURCE_SILVER_VIDEO, batch_id: str = SILVER_BATCH_ID) -> DataFrame:
    """Bronze video hits (flat or nested shape, possibly repeated across search
    queries) → silver (schema ``SILVER_VIDEO``), one row per video id."""
    return _typed_videos(_raw_videos(bronze), source, batch_id)


def video_survivors(bronze: DataFrame) -> DataFrame:
    """The raw survivor of each video id with the month of its publication."""
    one = _raw_videos(bronze)
    time = timestamp_of(one, "published_at")
    return one.withColumns({"year": F.year(time), "month": F.month(time)})


def videos_of(survivors: DataFrame) -> DataFrame:
    """Silver rows of raw survivors, row by row."""
    return _typed_videos(survivors, SOURCE_SILVER_VIDEO, SILVER_BATCH_ID)


def unparsed_crashes(silver: DataFrame) -> DataFrame:
    """Quarantine view: silver rows whose event time did not parse (R2)."""
    return silver.filter(F.col("crash_date").isNull())
