"""The stream that counts within a watermark: duplicates, late rows inside and beyond it, and restarts."""

from __future__ import annotations

import datetime

from strata.streaming.stateful import DAYS, count_days, daily_counts, monthly_counts

SCHEMA = "crash_record_id string, crash_date timestamp"


def drop(spark, root, name, rows):
    made = [(k, datetime.datetime(2024, 1, d, h, tzinfo=datetime.timezone.utc)) for k, d, h in rows]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(f"{root}/{name}")


def counts(spark, out):
    return {r.day.day: r.n for r in spark.read.schema(DAYS).parquet(out).collect()}


def run(spark, root, out, checkpoint):
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")
    return count_days(spark, events, "crash_date", "crash_record_id", out, checkpoint)


def test_counts_within_the_watermark(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / n) for n in ("drops", "days", "checkpoint"))
    drop(spark, root, "1", [("a", 1, 9), ("a", 1, 9), ("b", 1, 10), ("c", 2, 8)])
    run(spark, root, out, checkpoint)
    drop(spark, root, "2", [("a", 1, 9), ("d", 1, 23), ("e", 4, 12)])  # a again, d late but within two days; the mark goes to day 2
    run(spark, root, out, checkpoint)  # a restart from the checkpoint
    assert counts(spark, out) == {1: 3}  # a, b, d
    drop(spark, root, "3", [("f", 1, 5), ("g", 3, 1), ("h", 9, 1)])  # f is beyond the mark, g within it
    run(spark, root, out, checkpoint)
    assert counts(spark, out) == {1: 3, 2: 1, 3: 1, 4: 1}
    run(spark, root, out, checkpoint)  # nothing new
    assert counts(spark, out) == {1: 3, 2: 1, 3: 1, 4: 1}
    months = monthly_counts(spark.read.schema(DAYS).parquet(out)).collect()
    assert [(r.year, r.month, r.n) for r in months] == [(2024, 1, 6)]


def test_batch_and_stream_agree_without_late_rows(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / n) for n in ("drops", "days", "checkpoint"))
    for d in range(1, 8):
        drop(spark, root, f"{d}", [(f"k{d}-{i % 5}", d, i) for i in range(20)])
    run(spark, root, out, checkpoint)
    batch = {r.day.day: r.n for r in daily_counts(spark.read.schema(SCHEMA).parquet(f"{root}/*"), "crash_date", "crash_record_id").collect()}
    seen = counts(spark, out)
    assert seen and all(batch[d] == n == 5 for d, n in seen.items()) and set(seen) == {1, 2, 3, 4}
