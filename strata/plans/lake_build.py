"""Bronze → silver → gold → warehouse as one function (the end-to-end lake build).

Each layer is written, then read back from storage by the next one: the written table is
the lineage cut (an executor lost in a later layer never forces a recomputation from
bronze), and every layer reads only the columns and partitions it needs. Row counts are
collected with ``observe`` during the writes instead of extra ``count()`` jobs. Failures
raise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import schemas as S
from strata.operators.clean import first_present
from strata.functions.ids import duplicate_ids
from strata.plans import gold, silver, warehouse
from strata.sources.bronze import quarantined, read_bronze_crashes, read_bronze_videos
from strata.sources.lake import read_table, table_or_none, write_table


@dataclass(frozen=True)
class LakePaths:
    root: str

    def __getitem__(self, table: str) -> str:
        layer = {
            "silver_crashes": "silver/crashes", "silver_videos": "silver/videos",
            "hotspots": "gold/crash_hotspots", "risk_index": "gold/road_risk_index", "monthly": "gold/monthly",
            "dim_location": "warehouse/dim_location", "dim_risk": "warehouse/dim_risk",
            "fact_accidents": "warehouse/fact_accidents", "dim_risk_level": "warehouse/dim_risk_level",
            "fact_crashes": "warehouse/fact_crashes",
            "quarantine_crashes": "quarantine/crashes", "quarantine_videos": "quarantine/videos",
        }[table]
        return f"{self.root.rstrip('/')}/{layer}"


PARTITIONED = {"silver_crashes", "silver_videos", "hotspots", "fact_crashes"}


def _write(df: DataFrame, table: str, paths: LakePaths, counts: dict) -> None:
    obs = Observation(table)
    counts[table] = lambda: int(obs.get["rows"])
    parts = ("year", "month") if table in PARTITIONED else ()
    write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), paths[table], parts)


def load(spark: SparkSession, paths: LakePaths, table: str) -> DataFrame:
    return read_table(spark, paths[table], S.TABLE_SCHEMAS[table])


def _check_ids(df: DataFrame, id_col: str, key: list[str]) -> None:
    """Raise if two natural keys share a hashed id."""
    if not duplicate_ids(df, id_col, key).isEmpty():
        raise RuntimeError(f"{id_col} is not unique")


def _append_new(raw: DataFrame, clean: Callable[[DataFrame], DataFrame], table: str, paths: LakePaths, key: str,
                raw_key: Column, counts: dict) -> None:
    """Append the silver rows of the keys that the stored table lacks.

    All raw versions of a new key are cleaned together, whenever they happened or landed, so
    the row appended is the one a full build would choose. Stored keys stay as they are
    (insert-only). The delta is kept for its count and its write (an empty delta may be
    planned away entirely, so an ``observe`` on it would report nothing).
    """
    spark = raw.sparkSession
    target = read_table(spark, paths[table], S.TABLE_SCHEMAS[table])
    keyed = raw.withColumn("_key", raw_key)
    new = keyed.select("_key").filter(F.col("_key").isNotNull()).distinct().join(
        target.select(F.col(key).alias("_key")), "_key", "left_anti")
    rows = keyed.join(new, "_key", "left_semi").drop("_key")
    delta = clean(rows).select(*S.TABLE_SCHEMAS[table].fieldNames())
    delta = delta.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = delta.count()
        write_table(delta, paths[table], ("year", "month"), mode="append")
    finally:
        delta.unpersist()
    counts[table] = lambda: n


def build_lake(spark: SparkSession, crash_glob: str, video_root: str, lake_root: str,
               multi_line: bool = True, incremental: bool = False) -> dict[str, int]:
    """Build every table under ``lake_root``; returns rows written per table.

    ``incremental`` (when the silver tables exist) appends only new keys to silver instead
    of rebuilding it; only their rows are de-duplicated. Insert-only, like the original daily
    fetch. Gold and warehouse are rebuilt from silver either way. Malformed records and pages
    are written to quarantine tables and counted.
    """
    paths = LakePaths(lake_root)
    counts: dict = {}
    crashes_raw = read_bronze_crashes(spark, crash_glob, multi_line, keep_corrupt=True)
    videos_raw = read_bronze_videos(spark, video_root, multi_line, keep_corrupt=True)
    _write(quarantined(crashes_raw), "quarantine_crashes", paths, counts)
    _write(quarantined(videos_raw), "quarantine_videos", paths, counts)
    stored = table_or_none(spark, paths["silver_crashes"], S.SILVER_CRASH)

    if incremental and stored is not None and table_or_none(
            spark, paths["silver_videos"], S.SILVER_VIDEO) is not None:
        _append_new(crashes_raw, silver.silver_crashes, "silver_crashes", paths, "crash_record_id",
                    F.col("crash_record_id"), counts)
        _append_new(videos_raw, silver.silver_videos, "silver_videos", paths, "video_id",
                    first_present(videos_raw, "id.videoId", "video_id"), counts)
    else:
        _write(silver.silver_crashes(crashes_raw), "silver_crashes", paths, counts)
        _write(silver.silver_videos(videos_raw), "silver_videos", paths, counts)

    crashes, videos = load(spark, paths, "silver_crashes"), load(spark, paths, "silver_videos")
    _write(gold.hotspots(crashes), "hotspots", paths, counts)
    _write(gold.risk_index(crashes), "risk_index", paths, counts)
    _write(gold.monthly(crashes, videos), "monthly", paths, counts)

    hot, risk = load(spark, paths, "hotspots"), load(spark, paths, "risk_index")
    _write(warehouse.dim_location(hot), "dim_location", paths, counts)
    _write(warehouse.dim_risk(risk), "dim_risk", paths, counts)
    _write(warehouse.fact_accidents(hot, risk), "fact_accidents", paths, counts)
    _write(warehouse.risk_level_dim(spark), "dim_risk_level", paths, counts)
    _write(warehouse.star_fact(crashes, risk), "fact_crashes", paths, counts)
    where = list(gold.LOCATION)
    _check_ids(load(spark, paths, "dim_location"), "location_id", where)
    _check_ids(load(spark, paths, "dim_risk"), "risk_id", where)
    _check_ids(load(spark, paths, "fact_accidents"), "fact_id", [*where, "year", "month"])
    _check_ids(load(spark, paths, "dim_risk_level"), "level_id", ["risk_level"])
    return {t: get() for t, get in counts.items()}
