"""Golden tests for silver, gold and warehouse on the hand-made fixture (FIXTURES.md §3)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crash_rows import VIDEOS_FLAT, nested, write_pages
from strata.plans import gold, silver, warehouse
from strata.sources.bronze import read_bronze_videos


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_silver_crashes_golden(silver_crash_df):
    s = silver_crash_df
    assert sorted(r.crash_record_id for r in s.collect()) == ["c1", "c2", "c3", "c4", "c7", "c8"]
    c7 = s.filter("crash_record_id = 'c7'").first()
    assert c7.crash_date is None and c7.year is None and c7.month is None  # kept, unparsed (R2)
    c1 = s.filter("crash_record_id = 'c1'").first()
    assert (c1.year, c1.month, c1.latitude, c1.injuries_total) == (2024, 1, 41.9, 1.0)
    assert s.schema["latitude"].dataType.typeName() == "double"
    assert {r.source for r in s.collect()} == {"crash_api_silver"}
    assert {r.batch_id for r in s.collect()} == {"batch_001"}


def test_silver_drop_unparsed(spark, bronze_dirs):
    from strata.sources.bronze import read_bronze_crashes

    crashes, _ = bronze_dirs
    s = silver.silver_crashes(read_bronze_crashes(spark, f"{crashes}/*/*.json"), drop_unparsed=True)
    assert sorted(r.crash_record_id for r in s.collect()) == ["c1", "c2", "c3", "c4", "c8"]


def test_survivor_is_latest_then_vanishes_without_coordinates(spark):
    rows = [
        ("k1", "2024-01-01T00:00:00", "41.9", "-87.6", "2024-01-02 00:00:00"),
        ("k1", "2024-01-01T00:00:00", None, "-87.6", "2024-01-03 00:00:00"),  # newer, no coordinate
        ("k2", "2024-01-01T00:00:00", "NaN", "-87.6", "2024-01-02 00:00:00"),
        ("k3", "2024-01-01T00:00:00", "", "-87.6", "2024-01-02 00:00:00"),
        ("k4", "2024-01-01T00:00:00", "x", "-87.6", "2024-01-02 00:00:00"),
        ("k5", "2024-01-01T00:00:00", "41.95", "-87.6", "2024-01-02 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "crash_record_id string, crash_date string, latitude string, "
                                     "longitude string, ingestion_time string")
    s = silver.silver_crashes(df)
    assert [r.crash_record_id for r in s.collect()] == ["k5"]  # R1, R3


def test_dedup_is_deterministic_under_repartitioning(spark, silver_crash_df):
    from strata.operators.dedup import latest_per_key

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    base = latest_per_key(li, ["l_orderkey", "l_linenumber"])
    a = sorted(base.collect())
    b = sorted(latest_per_key(li.repartition(7), ["l_orderkey", "l_linenumber"]).collect())
    c = sorted(latest_per_key(li.repartition(1), ["l_orderkey", "l_linenumber"]).collect())
    assert a == b == c
    assert base.count() == li.select("l_orderkey", "l_linenumber").distinct().count()


def test_silver_videos_flat_and_nested_agree(spark, tmp_path, silver_video_df):
    flat = _rows(silver_video_df, "video_id", "title", "published_at", "year", "month")
    assert [r[0] for r in flat] == ["v1", "v2", "v3"]
    root = tmp_path / "nested"
    write_pages(root, "2024-03-10", "video_1.json", [nested(v) for v in VIDEOS_FLAT])
    nested_df = silver.silver_videos(read_bronze_videos(spark, str(root)))
    assert _rows(nested_df, "video_id", "title", "published_at", "year", "month") == flat
    v2 = silver_video_df.filter("video_id = 'v2'").first()
    assert (v2.year, v2.month) == (2024, 1)  # 23:59:59Z stays in January under UTC


def test_hotspots_golden(silver_crash_df):
    h = gold.hotspots(silver_crash_df)
    assert _rows(h.fillna(-1, subset=["year", "month"]), "latitude", "longitude", "year", "month",
                 "accident_count") == sorted([
        (10.0, 10.0, 2024, 3, 1), (41.8, -87.7, -1, -1, 1), (41.8, -87.7, 2024, 2, 1), (41.9, -87.6, 2024, 1, 3)])


def test_risk_index_golden(silver_crash_df):
    r = gold.risk_index(silver_crash_df)
    assert _rows(r, "latitude", "longitude", "accident_count", "bad_weather_count", "night_count",
                 "risk_score") == [(10.0, 10.0, 1, 1, 1, 1.0), (41.8, -87.7, 2, 0, 1, 1.2), (41.9, -87.6, 3, 2, 1, 2.3)]


def test_monthly_golden(silver_crash_df, silver_video_df):
    m = gold.monthly(silver_crash_df, silver_video_df)
    got = _rows(m.fillna(-1, subset=["year", "month"]), "year", "month", "accident_count", "youtube_video_count",
                "videos_per_100_accidents")
    assert got == [(-1, -1, 1, 0, 0.0), (2024, 1, 3, 2, 66.67), (2024, 2, 1, 0, 0.0), (2024, 3, 1, 0, 0.0)]
    assert {r.source for r in m.collect()} == {"gold_monthly_pipeline"}


def test_warehouse_golden(silver_crash_df):
    h, r = gold.hotspots(silver_crash_df), gold.risk_index(silver_crash_df)
    dl, dr, fact = warehouse.dim_location(h), warehouse.dim_risk(r), warehouse.fact_accidents(h, r)
    assert dl.count() == 3 and dr.count() == 3
    assert sorted(x.risk_score for x in fact.collect()) == [1.0, 1.2, 1.2, 2.3]
    # every fact row resolves both dimensions through its hashed keys
    assert fact.join(dl, "location_id", "left_anti").count() == 0
    assert fact.join(dr, "risk_id", "left_anti").count() == 0
    assert fact.select("fact_id").distinct().count() == fact.count()


def test_invariants_on_driver_tables(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    c = E._crashes(spark, sf)
    n = c.count()
    assert c.select("crash_record_id").distinct().count() == n
    total = lambda df: df.agg(F.sum("accident_count")).first()[0]
    assert total(E._hot(spark, sf)) == total(E._risk(spark, sf)) == total(E._monthly(spark, sf)) == n


def test_star_fact_levels(silver_crash_df):
    r = gold.risk_index(silver_crash_df)
    f = warehouse.star_fact(silver_crash_df, r)
    assert f.count() == 6
    dim = {x.risk_level: x.level_id for x in warehouse.risk_level_dim(silver_crash_df.sparkSession).collect()}
    assert len(set(dim.values())) == 3 and {(x.risk_level, x.level_id) for x in f.collect()} <= set(dim.items())
    levels = {x.crash_record_id: x.risk_level for x in f.collect()}
    assert levels["c1"] == "High" and levels["c8"] == "Low" and levels["c4"] == "Medium"  # 3/3, 1/3, 2/3


@pytest.mark.parametrize("score,level", [(70.0, "High"), (69.9, "Medium"), (40.0, "Medium"), (39.9, "Low"),
                                         (None, "Low")])
def test_level_cutoffs(spark, score, level):
    from strata.functions.labels import risk_level

    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(risk_level(F.col("s")).alias("l")).first().l == level


def test_scores_are_within_0_and_100_and_top_is_100(spark):
    import __spark_entry__ as E
    from strata.plans import dashboard as Q

    top = Q.top_hotspots(E._hot(spark, "/root/testdata/sf0.001"))
    stats = top.agg(F.min("risk_score"), F.max("risk_score"), F.count_if(F.col("rank") == 1),
                    F.count_if(F.col("risk_score") == 100.0)).first()
    periods = top.select("year", "month").distinct().count()
    assert 0.0 <= stats[0] and stats[1] == 100.0
    assert stats[2] == periods and stats[3] >= periods
