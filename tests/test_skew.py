"""A key that holds a third of all rows: results stay exact and the plan combines it
map-side before any shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import gold
from strata.plans.silver import silver_crashes

N = 90_000


def _rows():
    for i in range(N):
        key = "hot" if i % 3 == 0 else f"k{i}"
        yield key, f"{i % 7}", f"2024-01-01 00:00:{i % 60:02d}"


def _frame(spark):
    ids = spark.range(N, numPartitions=8)
    return ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("crash_record_id"),
        F.lit("2024-01-01T00:00:00").alias("crash_date"),
        (F.col("id") % 7).cast("string").alias("latitude"),
        F.lit("1.0").alias("longitude"),
        F.concat(F.lit("2024-01-01 00:00:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0")).alias("ingestion_time"),
    )


def test_hot_key_dedup_is_exact(spark):
    s = silver_crashes(_frame(spark))
    assert s.count() == N - N // 3 + 1
    # brute force: latest ingestion time, then the remaining columns (latitude text) larger first
    best = max((ing, lat) for key, lat, ing in _rows() if key == "hot")
    hot = s.filter("crash_record_id = 'hot'").first()
    assert (hot.latitude, hot.ingestion_time is not None) == (float(best[1]), True)


def test_hot_key_is_combined_before_the_shuffle(spark):
    s = silver_crashes(_frame(spark))
    plan = s._jdf.queryExecution().executedPlan().toString()
    exchange_at = plan.index("Exchange hashpartitioning(crash_record_id")
    assert "partial_max" in plan[exchange_at:]  # the partial step sits below the exchange


def test_hot_location_counts(spark):
    s = silver_crashes(_frame(spark))
    got = {r.latitude: r.accident_count for r in gold.risk_index(s).collect()}
    best_lat = float(max((ing, lat) for key, lat, ing in _rows() if key == "hot")[1])
    expected = {float(lat): sum(1 for i in range(N) if i % 3 != 0 and i % 7 == lat) for lat in range(7)}
    expected[best_lat] += 1
    assert got == expected
