"""Sources and sinks (S1-S13) and the end-to-end lake build."""

from __future__ import annotations

import pytest

from crash_rows import write_pages
from strata.plans.lake_build import LakePaths, build_lake, load
from strata.schemas import SILVER_CRASH
from strata.sources.bronze import PACKED, file_inventory, land_bronze, read_bronze_crashes, read_bronze_videos, read_json
from strata.sources.lake import (
    MissingTable,
    cut_lineage,
    files_without_rows,
    read_table,
    read_table_files,
    table_or_none,
    write_table,
)


def test_inventory_counts_empty_files(spark, bronze_dirs, tmp_path):
    crashes, videos = bronze_dirs
    write_pages(crashes, "2024-03-12", "crash_3.json", [])
    inv = file_inventory(spark, str(tmp_path / "bronze"))
    assert inv.count() == 4  # three crash pages (one empty) + one video page


def test_corrupt_file_is_quarantined(spark, tmp_path):
    d = tmp_path / "raw" / "2024-01-01"
    d.mkdir(parents=True)
    (d / "bad.json").write_text("[{\"crash_record_id\": \"x\",")
    from strata.schemas import BRONZE_CRASH

    df = read_json(spark, f"{tmp_path}/raw/*/*.json", BRONZE_CRASH, keep_corrupt=True).cache()
    assert df.filter("_corrupt_record IS NOT NULL").count() == 1


def test_land_then_read_lines(spark, bronze_dirs, tmp_path):
    crashes, _ = bronze_dirs
    raw = read_bronze_crashes(spark, f"{crashes}/*/*.json")
    out = str(tmp_path / "landed")
    land_bronze(raw, out, batch_id="1700000000")
    back = read_bronze_crashes(spark, out, multi_line=False)
    assert back.count() == 9  # the record without crash_date is not landed
    assert {r.source for r in back.collect()} == {"crash_api"}


def test_landed_lines_are_packed(spark, tmp_path):
    """Landing writes far less than the text of its rows, and all of it is read back."""
    raw = spark.range(20_000).selectExpr("cast(id as string) as crash_record_id", "'2024-01-01T00:00:00' as crash_date", "'RAIN' as weather_condition")
    out = tmp_path / "landed"
    landed = land_bronze(raw, str(out))
    text = sum(len(line) + 1 for line in landed.drop("ingest_date").toJSON().collect())
    assert sum(f.stat().st_size for f in out.rglob("part-*")) < text / 4
    assert read_bronze_crashes(spark, f"{out}/*", multi_line=False).select("crash_record_id").distinct().count() == 20_000
    videos = tmp_path / "videos" / "2024-03-10"
    spark.range(3).selectExpr("cast(id as string) as video_id").write.options(**PACKED).json(str(videos))
    assert read_bronze_videos(spark, str(tmp_path / "videos"), multi_line=False).count() == 3


def test_partitioned_roundtrip_and_pruning(spark, silver_crash_df, tmp_path):
    path = str(tmp_path / "silver")
    write_table(silver_crash_df, path, ["year", "month"])
    back = read_table(spark, path, SILVER_CRASH)
    assert back.count() == 6
    assert back.filter("year IS NULL").count() == 1  # unparsed date in the default partition
    plan = back.filter("year = 2024 AND month = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    flat = read_table_files(spark, path)
    assert flat.count() == 6 and "year" not in flat.columns


@pytest.mark.parametrize("name", ["a-first.parquet", "zz-last.parquet"])
@pytest.mark.parametrize("schema", [None, "id long"])
def test_unreadable_file_is_skipped_and_named(spark, tmp_path, name, schema):
    path = tmp_path / "files"
    spark.range(5).repartition(1).write.parquet(str(path))
    (path / name).write_bytes(b"not parquet")
    assert read_table_files(spark, str(path), schema).count() == 5
    named = files_without_rows(spark, str(path), schema).collect()
    assert [r.path.rsplit("/", 1)[1] for r in named] == [name]


def test_missing_table(spark, tmp_path):
    assert table_or_none(spark, str(tmp_path / "nope"), SILVER_CRASH) is None
    with pytest.raises(MissingTable):
        read_table(spark, str(tmp_path / "nope"))


def test_reliable_checkpoint(spark, silver_crash_df):
    cut = cut_lineage(silver_crash_df)
    assert cut.count() == 6
    assert spark.sparkContext.getCheckpointDir()


def test_lake_build_end_to_end(spark, bronze_dirs, tmp_path):
    crashes, videos = bronze_dirs
    lake = str(tmp_path / "lake")
    counts = build_lake(spark, f"{crashes}/*/*.json", str(videos), lake)
    assert counts == {"silver_crashes": 6, "silver_videos": 3, "hotspots": 4, "risk_index": 3, "monthly": 4,
                      "dim_location": 3, "dim_risk": 3, "fact_accidents": 4, "dim_risk_level": 3, "fact_crashes": 6,
                      "quarantine_crashes": 0, "quarantine_videos": 0}
    fact = load(spark, LakePaths(lake), "fact_accidents")
    assert sorted(r.risk_score for r in fact.collect()) == [1.0, 1.2, 1.2, 2.3]
    crash_fact = load(spark, LakePaths(lake), "fact_crashes")
    for dim, key in (("dim_location", "location_id"), ("dim_risk_level", "level_id")):
        assert crash_fact.filter(f"{key} IS NULL").isEmpty()
        assert crash_fact.join(load(spark, LakePaths(lake), dim), key, "left_anti").isEmpty()


def test_malformed_page_is_quarantined_and_counted(spark, bronze_dirs, tmp_path):
    crashes, videos = bronze_dirs
    (crashes / "2024-03-11" / "crash_cut.json").write_text('[{"crash_record_id": "x1", "crash_date": "2024-01-')
    counts = build_lake(spark, f"{crashes}/*/*.json", str(videos), str(tmp_path / "lake"))
    assert counts["quarantine_crashes"] == 1 and counts["silver_crashes"] == 6
    kept = spark.read.parquet(LakePaths(str(tmp_path / "lake"))["quarantine_crashes"]).collect()
    assert "x1" in kept[0]["_corrupt_record"] and kept[0]["file"].endswith("crash_cut.json")


def test_incremental_build_agrees_with_full_build_on_late_and_corrected_keys(spark, bronze_dirs, tmp_path):
    """A key that is late, and one whose corrected version is older than the stored mark."""
    import json

    crashes, videos = bronze_dirs
    glob, lake = f"{crashes}/*/*.json", str(tmp_path / "lake")
    build_lake(spark, glob, str(videos), lake)
    base = {"weather_condition": "RAIN", "latitude": 41.9, "longitude": -87.6, "injuries_total": 1, "injuries_fatal": 0}
    rows = [{"crash_record_id": "late", "crash_date": "2023-12-01T00:00:00.000", "ingestion_time": "2024-03-12 08:00:00"} | base,
            {"crash_record_id": "x", "crash_date": "2024-05-01T00:00:00.000", "ingestion_time": "2024-03-12 08:00:00"} | base,
            {"crash_record_id": "x", "crash_date": "2024-01-02T00:00:00.000", "ingestion_time": "2024-03-13 08:00:00"} | base]
    day = crashes / "2024-03-12"
    day.mkdir()
    (day / "crash_3.json").write_text(json.dumps(rows))
    assert build_lake(spark, glob, str(videos), lake, incremental=True)["silver_crashes"] == 2
    full = str(tmp_path / "full")
    build_lake(spark, glob, str(videos), full)
    tables = [load(spark, LakePaths(p), "silver_crashes").select("crash_record_id", "crash_date", "latitude").collect()
              for p in (lake, full)]
    assert sorted(tables[0]) == sorted(tables[1])


def test_replace_one_month_only(spark, silver_crash_df, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "silver")
    write_table(silver_crash_df, path, ["year", "month"])
    january = silver_crash_df.filter("year = 2024 AND month = 1").withColumn("weather_condition", F.lit("REDONE"))
    write_table(january, path, ["year", "month"], replace_partitions_only=True)
    back = read_table(spark, path, SILVER_CRASH)
    assert back.count() == 6
    assert {r.weather_condition for r in back.filter("month = 1").collect()} == {"REDONE"}
    assert back.filter("month = 2").count() == 1 and back.filter("year IS NULL").count() == 1


def test_lake_build_incremental_appends_new_keys_only(spark, bronze_dirs, tmp_path):
    crashes, videos = bronze_dirs
    lake = str(tmp_path / "lake")
    build_lake(spark, f"{crashes}/*/*.json", str(videos), lake)
    new_page = [
        {"crash_record_id": "c9", "crash_date": "2024-03-05T10:00:00.000", "weather_condition": "RAIN",
         "lighting_condition": "DARKNESS", "latitude": 10.0, "longitude": 10.0, "injuries_total": 1,
         "injuries_fatal": 0, "ingestion_time": "2024-03-12 08:00:00"},
        {"crash_record_id": "c8", "crash_date": "2024-03-01T00:00:00.000", "weather_condition": "FOG",
         "lighting_condition": "DUSK", "latitude": 10.0, "longitude": 10.0, "injuries_total": 0,
         "injuries_fatal": 0, "ingestion_time": "2024-03-12 08:00:00"},
    ]
    write_pages(crashes, "2024-03-12", "crash_3.json", new_page)
    counts = build_lake(spark, f"{crashes}/*/*.json", str(videos), lake, incremental=True)
    assert counts["silver_crashes"] == 1 and counts["silver_videos"] == 0
    paths = LakePaths(lake)
    assert load(spark, paths, "silver_crashes").count() == 7
    risk = {(r.latitude, r.longitude): r.accident_count for r in load(spark, paths, "risk_index").collect()}
    assert risk[(10.0, 10.0)] == 2


def test_cluster_profile_settings():
    from strata.session import BASE_CONF, CLUSTER_CONF

    assert BASE_CONF["spark.sql.session.timeZone"] == "UTC" and BASE_CONF["spark.ui.enabled"] == "false"
    assert CLUSTER_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    assert set(CLUSTER_CONF).isdisjoint({"spark.checkpoint.dir"})  # the cluster names it, not the library


def test_cluster_partitions_grow_with_the_input():
    from strata.session import build_session, initial_partitions

    assert initial_partitions(1) == 200 and initial_partitions(100 << 40) == 409_600
    with pytest.raises(ValueError):
        build_session(cluster=True)


def test_shared_id_of_two_keys_stops_the_build(spark):
    from strata.plans.lake_build import _check_ids

    rows = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 2.0), (2, 1.0, 3.0)], "i long, x double, y double")
    _check_ids(rows, "i", ["x", "y"])
    with pytest.raises(RuntimeError):
        _check_ids(rows.unionByName(rows.selectExpr("i", "x + 1 AS x", "y")), "i", ["x", "y"])


def test_crash_pages_lie_in_few_folders(spark, tmp_path):
    """One file a page, but no folder of its own for each: listing and commit cost by folder."""
    import __spark_entry__ as E

    rows = spark.range(120_000).selectExpr(
        "id as l_orderkey", "id as l_partkey", "id % 9 as l_suppkey", "cast(1 as int) as l_linenumber", "cast(id % 50 as double) as l_quantity",
        "1.0D as l_extendedprice", "0.1D as l_discount", "0.1D as l_tax", "'A' as l_returnflag", "'F' as l_linestatus",
        "cast('1996-01-01' as timestamp_ntz) as l_shipdate")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    out = E._crash_pages(spark, str(tmp_path))
    files = out.inputFiles()
    assert len(files) == 480 and len({f.rpartition("/")[0] for f in files}) <= 10
    assert out.select("crash_record_id").distinct().count() == out.count() == 120_000
