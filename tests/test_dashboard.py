"""Dashboard queries (Q1-Q18) and stated findings (X1-X7) on the golden fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.rank import newest
from strata.plans import dashboard as Q
from strata.plans import gold, insights


def test_kpis_one_period_and_all_periods(silver_crash_df):
    one = Q.period_kpis(silver_crash_df, (2024, 1)).first()
    assert (one.total_crashes, one.total_injuries, one.total_fatalities, one.mappable) == (3, 3, 1, 3)
    per = {(r.year, r.month): r.total_crashes for r in Q.period_kpis(silver_crash_df).collect()}
    assert per == {(2024, 1): 3, (2024, 2): 1, (2024, 3): 1, (None, None): 1}


def test_empty_period_sums_are_zero(silver_crash_df):
    r = Q.period_kpis(silver_crash_df, (1999, 1)).first()
    assert (r.total_crashes, r.total_injuries, r.total_fatalities, r.mappable) == (0, 0, 0, 0)


def test_breakdowns(silver_crash_df):
    w = Q.weather_breakdown(silver_crash_df, (2024, 1)).collect()
    assert [(r.weather_condition, r.crashes) for r in w] in ([("RAIN", 1), ("SNOW", 1), ("CLEAR", 1)],) or \
        sorted((r.weather_condition, r.crashes) for r in w) == [("CLEAR", 1), ("RAIN", 1), ("SNOW", 1)]
    t = Q.crash_type_breakdown(silver_crash_df, (2024, 1), top=1).collect()
    assert [(r.first_crash_type, r.crashes) for r in t] == [("REAR END", 2)]
    lighting = Q.lighting_breakdown(silver_crash_df, (2024, 2)).collect()
    assert [(r.lighting_condition, r.crashes) for r in lighting] == [("DAWN", 1)]
    # NULL weather of c4 is not a category
    assert Q.weather_breakdown(silver_crash_df, (2024, 2)).count() == 0


def test_top_k_tie_at_the_cut_is_broken_by_value(spark):
    df = spark.createDataFrame([(2024, 1, v) for v in ["b", "a", "c", "c"]], "year int, month int, v string")
    got = [(r.v, r.crashes) for r in Q.category_breakdown(df, "v", top=2).orderBy(F.desc("crashes"), "v").collect()]
    assert got == [("c", 2), ("a", 1)]


def test_hourly(silver_crash_df):
    got = [(r.hour, r.crashes) for r in Q.hourly_profile(silver_crash_df, (2024, 1)).collect()]
    assert got == [(8, 1), (14, 1), (22, 1)]


def test_map_points_box(silver_crash_df):
    assert Q.map_points(silver_crash_df, (2024, 3)).count() == 0
    assert Q.map_points(silver_crash_df, (2024, 1)).count() == 3


def test_top_hotspots_scored(silver_crash_df):
    raw = Q.top_hotspots_from_crashes(silver_crash_df, (2024, 1)).collect()
    assert [(r.rank, r.latitude, r.longitude, r.accident_count, r.risk_score, r.risk_level) for r in raw] == [
        (1, 41.9, -87.6, 3, 100.0, "High")]
    from_gold = Q.top_hotspots(gold.hotspots(silver_crash_df), (2024, 1)).collect()
    assert from_gold == raw


def test_score_rounding_is_half_even(spark):
    # 1/16 * 100 = 6.25 → 6.2 half-even (pandas-style), where half-up would give 6.3
    rows = [(2024, 1, float(i), 0.0, n) for i, n in enumerate([16, 1])]
    df = spark.createDataFrame(rows, "year int, month int, latitude double, longitude double, accident_count long")
    got = {r.accident_count: r.risk_score for r in Q.top_hotspots(df).collect()}
    assert got == {16: 100.0, 1: 6.2}


def test_risk_panels(silver_crash_df):
    r = gold.risk_index(silver_crash_df)
    k = Q.risk_kpis(r).first()
    assert (k.total_locations, k.total_accidents, k.avg_risk_score) == (3, 6, 1.5)
    top = Q.top_risk(r, k=2).collect()
    assert [(x.rank, x.risk_score) for x in top] == [(1, 2.3), (2, 1.2)]
    labels = [x.location for x in Q.risk_distribution(r).collect()]
    assert labels == ["41.9,-87.6", "41.8,-87.7", "10.0,10.0"]


def test_monthly_panels(silver_crash_df, silver_video_df):
    m = gold.monthly(silver_crash_df, silver_video_df)
    trend = [(r.period, r.accident_count, r.youtube_video_count) for r in Q.monthly_trend(m).collect()]
    assert trend[1:] == [("Jan 2024", 3, 2), ("Feb 2024", 1, 0), ("Mar 2024", 1, 0)]
    assert trend[0][0] is None  # the unparsed-date group has no label
    ratios = [r.videos_per_100_accidents for r in Q.ratio_by_period(m).collect()]
    assert ratios[1] == 66.67


def test_years_periods_preview_layers(silver_crash_df, silver_video_df):
    assert [(r.year, r.records) for r in Q.records_per_year(silver_crash_df).collect()] == [(2024, 5)]
    assert [(r.year, r.month) for r in Q.available_periods(silver_crash_df).collect()] == [(2024, 1), (2024, 2),
                                                                                             (2024, 3)]
    assert [r.year for r in Q.available_years(silver_crash_df).collect()] == [2024]
    assert [r.month for r in Q.available_months_of(silver_crash_df, 2024).collect()] == [1, 2, 3]
    assert [r.crash_record_id for r in Q.preview(silver_crash_df, n=2).collect()] == ["c1", "c2"]
    layers = {r.layer: r.rows for r in Q.layer_counts({"a": silver_crash_df, "b": silver_video_df}).collect()}
    assert layers == {"a": 6, "b": 3}
    assert [r.crash_record_id for r in newest(silver_crash_df, "crash_date", 2, ["crash_record_id"]).collect()] == [
        "c8", "c4"]


def test_findings(silver_crash_df, silver_video_df):
    h = gold.hotspots(silver_crash_df)
    assert insights.persistent_hotspots(h, min_years=1).count() == 3
    assert insights.persistent_hotspots(h, min_years=2).count() == 0
    rates = {r.lighting_condition: r.fatality_rate for r in insights.fatality_rate(silver_crash_df).collect()}
    assert rates["DARKNESS, LIGHTED ROAD"] == 1.0 and rates["DARKNESS"] == 0.0
    yoy = insights.year_over_year(silver_crash_df).collect()
    assert [(r.year, r.records, r.prev_records, r.is_peak) for r in yoy] == [(2024, 5, None, True)]
    bins = {(r.lat_bin, r.lon_bin): r.crashes for r in insights.grid_bins(silver_crash_df, cell=1.0).collect()}
    assert bins == {(41, -88): 5, (10, 10): 1}
    corr = insights.crash_video_correlation(silver_crash_df, silver_video_df).first()
    assert corr.months == 3
    assert round(corr.corr_same_month, 6) == 1.0
    n = gold.normalised_risk(gold.risk_index(silver_crash_df)).collect()
    assert sorted((r.normalised_score, r.risk_level) for r in n) == [(33.3, "Low"), (66.7, "Medium"),
                                                                      (100.0, "High")]


def test_gold_map_points_from_top_hotspots(silver_crash_df):
    top = Q.top_hotspots(gold.hotspots(silver_crash_df), (2024, 1))
    pts = Q.map_points(top, key=None).collect()
    assert [(r.latitude, r.longitude) for r in pts] == [(41.9, -87.6)]


def test_next_page_and_period_repair(spark, silver_crash_df):
    from strata.operators import next_page, with_period

    page = next_page(silver_crash_df, "crash_date", 2, after="2024-01-05 14:30:00", key=["crash_record_id"])
    assert [r.crash_record_id for r in page.collect()] == ["c2", "c3"]
    df = spark.createDataFrame([("x", "2024-05-06 00:00:00"), ("2023", "2024-05-06 00:00:00")],
                               "year string, ts string").selectExpr("year", "cast(ts as timestamp) ts")
    assert [(r.year, r.month) for r in with_period(df, "ts").collect()] == [(2024, 5), (2023, 5)]


def test_missing_layer_is_shown_without_rows(spark, silver_crash_df):
    layers = {r.layer: r.rows for r in Q.layer_counts({"a": silver_crash_df, "gone": None}).collect()}
    assert layers == {"a": silver_crash_df.count(), "gone": None}
