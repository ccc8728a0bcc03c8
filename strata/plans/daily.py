"""The daily load (T1, G3-G5): new landings become the next lake version, without rereading the rest.

One run takes a bounded number of unlisted bronze files per feed, keeps one row per key of them, and
merges these into what is stored:

* The *state* tables hold one raw survivor per key (also of keys that silver drops for want of
  coordinates), partitioned by the month of the event; silver is a projection of a state row.
* The *key index* maps the hash of a key to the month of its survivor, in buckets by hash. A run reads
  the buckets of its keys, then only the months that may hold one of them. Hashes that collide or
  entries gone stale point to a month too many, never to one too few, so the merge is exact.
* ``upsert`` (default): a key's survivor is chosen by the order that the full build uses, so the
  result equals a full build over all landings, also for late, corrected and moved keys. Partitions are
  rewritten where a stored row was replaced; elsewhere rows are appended. ``insert_only`` keeps stored
  keys as they are, like the original fetch.
* Gold counts are additive: new rows count +1 and replaced rows -1, and only months with a change are
  merged and rewritten. The all-time risk table is merged from its own counts, not from silver.

* Malformed records of the new files go to the quarantine table with their file.

All changed tables and the landing log are committed as one version (see ``strata.sources.versions``).
``rebuild_lake`` works the whole landing off anew, in the same bounded steps but beside the tables in use, and
swaps all of them by one commit. The warehouse (G6-G8, X6) is read off a version: its ids are hashes of the
keys and its scores change with every crash of a location, so a stored copy would be rewritten daily.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas as S
from strata.defaults import BAD_WEATHER, NIGHT_LIGHTING, RISK_WEIGHTS
from strata.operators.clean import is_one_of, require_not_null
from strata.plans import silver, warehouse
from strata.plans.gold import LOCATION, monthly_table, scored
from strata.session import scratch_path
from strata.sources.bronze import malformed, read_bronze_crashes, read_bronze_videos
from strata.sources.lake import MissingTable
from strata.sources.versions import Lake, Version, partition_of, partition_path
from strata.streaming.landing import next_files, unlisted

MONTH = ("year", "month")
#: Buckets of the key index; a run with few keys reads the buckets of these alone.
INDEX_BUCKETS = 64


@dataclass(frozen=True)
class Feed:
    """A bronze source: how to read it, its raw survivor columns, and the silver projection of a survivor."""

    name: str
    key: str
    read: Callable[..., DataFrame]
    raw: Callable[[DataFrame], DataFrame]
    project: Callable[[DataFrame], DataFrame]
    schema: StructType

    @property
    def state(self) -> str:
        return f"{self.name}_state"

    @property
    def index(self) -> str:
        return f"{self.name}_keys"

    def state_schema(self, spark: SparkSession) -> StructType:
        return self.raw(spark.createDataFrame([], S.BRONZE_CRASH if self.name == "silver_crashes" else S.BRONZE_VIDEO)).schema


CRASHES = Feed("silver_crashes", "crash_record_id", read_bronze_crashes, silver.crash_survivors, silver.crashes_of, S.SILVER_CRASH)
VIDEOS = Feed("silver_videos", "video_id", read_bronze_videos, silver.video_survivors, silver.videos_of, S.SILVER_VIDEO)


def key_hash(key: str) -> Column:
    return F.xxhash64(F.col(key))


def months_of(index: DataFrame, delta: DataFrame, key: str) -> list[str]:
    """Partitions that may hold a key of ``delta``: by the index buckets of its keys, then by their hashes."""
    hashes = delta.select(key_hash(key).alias("hash"))
    buckets = [r.b for r in hashes.select(F.pmod("hash", F.lit(INDEX_BUCKETS)).cast("int").alias("b")).distinct().collect()]
    near = index.where(F.col("bucket").isin(buckets)).join(hashes, "hash", "left_semi")
    return sorted(partition_path(MONTH, (r.year, r.month)) for r in near.select(*MONTH).distinct().collect())


def keys_absent(lake: Lake, feed: Feed, base: Version, delta: DataFrame) -> DataFrame:
    """Rows of ``delta`` whose key the stored table lacks; reads the partitions that the key index points to."""
    schema = feed.state_schema(lake.spark)
    months = months_of(lake.read(feed.index, S.KEY_INDEX, base), delta, feed.key)
    stored = lake.read(feed.state, schema, base, months).select(feed.key)
    return delta.join(stored.join(delta.select(feed.key), feed.key, "left_semi"), feed.key, "left_anti")


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: used several times, computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Merge:
    """What a run changes in one feed: folders by table, and the silver rows that come and go."""

    changes: dict[str, list[str]]
    added: DataFrame
    removed: DataFrame
    rows: int


def changed_rows(stored: DataFrame, fresh: DataFrame, key: str, upsert: bool = True) -> DataFrame:
    """The rows of ``fresh`` that come in, each with the stored row that it replaces as ``_old``; both sides have one row a key.

    The better of both by the order of ``latest_per_key``, so one join tells all; rows that agree change nothing.
    """
    fields = [c for c in fresh.columns if c != key]
    order = [c for c in fields if c == "_ingested"] + [c for c in fields if c != "_ingested"]
    both = fresh.join(stored.select(key, F.struct(*order).alias("_old")), key, "left")
    better = F.col("_old").isNull() | (F.struct(*order) > F.col("_old")) if upsert else F.col("_old").isNull()
    return both.where(better).select(*fresh.columns, "_old")


def merge_feed(lake: Lake, feed: Feed, base: Version | None, bronze: DataFrame, upsert: bool = True) -> Merge:
    """Stage the merge of new bronze rows into a feed's state, silver and key index."""
    spark = lake.spark
    schema = feed.state_schema(spark)
    fresh = _written(feed.raw(bronze), f"{feed.name}-fresh")
    folders = {t: list(base.folders(t)) if base else [] for t in (feed.state, feed.name, feed.index)}
    near: list[str] = []
    if folders[feed.state]:
        months = set(months_of(lake.read_folders(feed.index, S.KEY_INDEX, folders[feed.index]), fresh, feed.key))
        near = [f for f in folders[feed.state] if partition_of(f) in months]
    if near:
        pairs = _written(changed_rows(lake.read_folders(feed.state, schema, near), fresh, feed.key, upsert), f"{feed.name}-won")
        won, old = pairs.select(*schema.fieldNames()), pairs.where(F.col("_old").isNotNull())
        replaced = old.select(*[F.col(c if c == feed.key else f"_old.{c}") for c in schema.fieldNames()])
        moved = pairs.where(F.col("_old").isNull() | ~reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_old.{c}")) for c in MONTH]))
    else:
        won, replaced, moved = fresh, fresh.where(F.lit(False)), fresh

    # copy-on-write: only folders that hold a replaced row are written anew
    hit = {partition_path(MONTH, (r.year, r.month)) for r in replaced.select(*MONTH).distinct().collect()} if near else set()
    for table, rows in ((feed.state, schema), (feed.name, feed.schema)):
        if own := [f for f in folders[table] if partition_of(f) in hit]:
            left = lake.read_folders(table, rows, own).join(replaced.select(feed.key), feed.key, "left_anti")
            folders[table] = [f for f in folders[table] if f not in set(own)] + lake.stage(left, table, MONTH)
    n, new = won.count(), []
    if n:
        state = lake.stage(won, feed.state, MONTH)
        folders[feed.state] += state
        # read off the staged state, which lies by month already
        new = lake.stage(feed.project(lake.read_folders(feed.state, schema, state)).select(*feed.schema.fieldNames()), feed.name, MONTH, dealt=True)
        folders[feed.name] += new
        # a key that stays in its month has its entry; one that comes back to a month may get a second
        entries = moved.select(key_hash(feed.key).alias("hash"), *MONTH).withColumn("bucket", F.pmod("hash", F.lit(INDEX_BUCKETS)).cast("int"))
        folders[feed.index] += lake.stage(entries, feed.index, ["bucket"])
    added = lake.read_folders(feed.name, feed.schema, new)
    return Merge({t: sorted(f) for t, f in folders.items()}, added, feed.project(replaced).select(*feed.schema.fieldNames()), n)


def _signed(added: DataFrame, removed: DataFrame, group: Sequence[str], counts: dict[str, Column]) -> DataFrame:
    """Counts of the added rows less those of the removed ones, where they differ from 0."""
    both = added.withColumn("_sign", F.lit(1)).unionByName(removed.withColumn("_sign", F.lit(-1)))
    out = both.groupBy(*group).agg(*[F.sum(F.when(c, F.col("_sign")).otherwise(0)).cast("long").alias(n) for n, c in counts.items()])
    return out.where(reduce(Column.__or__, [F.col(n) != 0 for n in counts]))


def merge_counts(lake: Lake, table: str, schema: StructType, base: Version | None, delta: DataFrame, group: Sequence[str],
                 counts: Sequence[str], partition_by: Sequence[str] = (), keep: str | None = None) -> list[str]:
    """Stage ``table`` with the signed counts of ``delta`` added, and return its folders.

    Only partitions that ``delta`` touches are read and written; a group whose ``keep`` (the first count by
    default) falls to 0 goes.
    """
    folders = list(base.folders(table)) if base else []
    delta = _written(delta, f"{table}-delta")
    if delta.isEmpty():
        return folders
    touched = {partition_path(partition_by, tuple(r)) for r in delta.select(*partition_by).distinct().collect()} if partition_by else {""}
    old = [f for f in folders if partition_of(f) in touched]
    stored = lake.read_folders(table, schema, old)
    merged = stored.select(*schema.fieldNames()).unionByName(delta.select(*schema.fieldNames())).groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in counts]).where(F.col(keep or counts[0]) > 0)
    return sorted([f for f in folders if f not in set(old)] + lake.stage(merged.select(*schema.fieldNames()), table, partition_by))


def _step(lake: Lake, base: Version | None, crash_root: str, video_root: str, multi_line: bool, upsert: bool, max_files: int,
          glob: str, bad_weather: Sequence[str], night: Sequence[str]) -> tuple[dict[str, int], dict[str, list[str]]]:
    """Stage what up to ``max_files`` new files a feed change in ``base``: files and changed rows by feed, and the
    folders of the changed tables (none without a new file)."""
    spark = lake.spark
    log = lake.read_folders("landing_log", S.LANDING_LOG, base.folders("landing_log") if base else [])
    changes: dict[str, list[str]] = {}
    counts: dict[str, int] = {}
    merges: dict[str, Merge] = {}
    listed: list[tuple[str, str, int]] = []
    refused = list(base.folders("quarantine")) if base else []
    for feed, root in ((CRASHES, crash_root), (VIDEOS, video_root)):
        files = next_files(unlisted(spark, feed.name, root, log, glob), max_files)
        counts[f"{feed.name}_files"], counts[feed.name] = len(files), 0
        if files:
            listed += [(feed.name, *f) for f in files]
            bronze = feed.read(spark, [f for f, _ in files], multi_line, keep_corrupt=True)
            merges[feed.name] = merge_feed(lake, feed, base, bronze, upsert)
            changes |= merges[feed.name].changes
            counts[feed.name] = merges[feed.name].rows
            refused += lake.stage(malformed(bronze, feed.name).select(*S.QUARANTINE.fieldNames()), "quarantine")
    if not listed:
        return counts, {}

    deltas = []
    if CRASHES.name in merges:
        m = merges[CRASHES.name]
        located = [require_not_null(x, *LOCATION) for x in (m.added, m.removed)]
        every = F.lit(True)
        hot = _signed(*located, [*LOCATION, *MONTH], {"accident_count": every})
        changes["hotspots"] = merge_counts(lake, "hotspots", S.HOTSPOTS, base, hot, [*LOCATION, *MONTH], ["accident_count"], MONTH)
        kinds = {"accident_count": every, "bad_weather_count": is_one_of(F.col("weather_condition"), bad_weather),
                 "night_count": is_one_of(F.col("lighting_condition"), night)}
        changes["risk_counts"] = merge_counts(lake, "risk_counts", S.RISK_COUNTS, base, _signed(*located, LOCATION, kinds), LOCATION, list(kinds))
    for feed, time in ((CRASHES, "crash_date"), (VIDEOS, "published_at")):
        if feed.name in merges:
            dated = [x.select(F.lit(feed.name).alias("feed"), F.year(time).alias("year"), F.month(time).alias("month"))
                     for x in (merges[feed.name].added, merges[feed.name].removed)]
            deltas.append(_signed(*dated, ["feed", *MONTH], {"n": F.lit(True)}))
    changes["month_counts"] = merge_counts(lake, "month_counts", S.MONTH_COUNTS, base, reduce(DataFrame.unionByName, deltas), ["feed", *MONTH], ["n"])
    changes["quarantine"] = sorted(refused)
    changes["landing_log"] = sorted([*(base.folders("landing_log") if base else []),
                                     *lake.stage(spark.createDataFrame(listed, S.LANDING_LOG), "landing_log")])
    return counts, changes


def daily_load(spark: SparkSession, lake_root: str, crash_root: str, video_root: str, multi_line: bool = True, upsert: bool = True,
               max_files: int = 10_000, glob: str = "*.json", bad_weather: Sequence[str] = BAD_WEATHER,
               night: Sequence[str] = NIGHT_LIGHTING, before_commit: Callable[[], None] | None = None) -> dict[str, int]:
    """Take in up to ``max_files`` new files a feed and commit the next version; returns files and changed rows by feed.

    Call it until no file is left to work off a backlog in bounded steps. Without a new file nothing is committed.
    ``before_commit`` is called once everything is staged (tests end the run there).
    """
    lake = Lake(spark, lake_root)
    base = lake.version()
    counts, changes = _step(lake, base, crash_root, video_root, multi_line, upsert, max_files, glob, bad_weather, night)
    if changes:
        if before_commit:
            before_commit()
        lake.commit(base, changes)
    return counts


def rebuild_lake(spark: SparkSession, lake_root: str, crash_root: str, video_root: str, multi_line: bool = True,
                 max_files: int = 10_000, glob: str = "*.json", bad_weather: Sequence[str] = BAD_WEATHER,
                 night: Sequence[str] = NIGHT_LIGHTING, before_commit: Callable[[], None] | None = None) -> dict[str, int]:
    """Build every table anew from all landings and swap them by one commit; returns files and rows taken in by feed.

    Readers see the tables in use until then, and keep them if the build dies. Files are worked off in steps of
    ``max_files`` a feed, each on what the steps before have staged; no step is a version. A load that commits
    meanwhile makes this commit fail (``StaleVersion``), for its rows would be lost.
    """
    lake = Lake(spark, lake_root)
    current = lake.version()
    staged, total = Version(0), {}
    while True:
        counts, changes = _step(lake, staged, crash_root, video_root, multi_line, True, max_files, glob, bad_weather, night)
        total = {k: total.get(k, 0) + n for k, n in counts.items()}
        if not changes:
            break
        staged = Version(0, {**staged.tables, **changes})
    if before_commit:
        before_commit()
    lake.commit(current, {**{t: [] for t in (current.tables if current else {})}, **staged.tables})
    return total


#: Tables of the warehouse that ``load`` reads off a version.
WAREHOUSE = ("dim_location", "dim_risk", "dim_risk_level", "fact_accidents", "fact_crashes")


def load(lake: Lake, table: str, version: Version | None = None) -> DataFrame:
    """A table of the daily lake as readers see it: silver, gold, warehouse, quarantine or landing log.

    The locations are those of the risk counts, one row each, so ``dim_location`` needs no ``distinct``.
    """
    version = version or lake.version()
    if version is None:
        raise MissingTable(f"{lake.root}: no version")
    if table == "risk_index":
        return scored(lake.read("risk_counts", S.RISK_COUNTS, version), RISK_WEIGHTS)
    if table == "monthly":
        counts = lake.read("month_counts", S.MONTH_COUNTS, version)
        by = {f.name: counts.where(F.col("feed") == f.name).select(*MONTH, "n") for f in (CRASHES, VIDEOS)}
        return monthly_table(by[CRASHES.name].withColumnRenamed("n", "accident_count"),
                             by[VIDEOS.name].withColumnRenamed("n", "youtube_video_count"))
    if table == "dim_risk_level":
        return warehouse.risk_level_dim(lake.spark)
    if table in WAREHOUSE:
        risk = load(lake, "risk_index", version)
        if table == "dim_location":
            return risk.select(*LOCATION, warehouse.location_id().alias("location_id"))
        if table == "dim_risk":
            return warehouse.dim_risk(risk)
        if table == "fact_accidents":
            return warehouse.fact_accidents(load(lake, "hotspots", version), risk)
        return warehouse.star_fact(load(lake, "silver_crashes", version), risk)
    schema = {"quarantine": S.QUARANTINE, "silver_crashes": S.SILVER_CRASH, "silver_videos": S.SILVER_VIDEO, "hotspots": S.HOTSPOTS, "landing_log": S.LANDING_LOG}[table]
    return lake.read(table, schema, version)
