"""Incremental loads: high-water mark (T1) and file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from crash_rows import CRASHES, write_pages
from strata.plans.silver import silver_crashes
from strata.schemas import BRONZE_CRASH, SILVER_CRASH
from strata.sources.lake import read_table
from strata.streaming import incremental_delta, incremental_load, read_bronze_stream, stream_into_table


def _silver(spark, rows):
    return silver_crashes(spark.createDataFrame(rows, BRONZE_CRASH))


def _row(key, ts, ingested="2024-03-10 00:00:00"):
    return {"crash_record_id": key, "crash_date": ts, "latitude": "41.9", "longitude": "-87.6",
            "ingestion_time": ingested}


def _as_tuple(d):
    return tuple(d.get(f.name) for f in BRONZE_CRASH.fields)


def test_mark_ties_and_strict_cut(spark):
    target = _silver(spark, [_as_tuple(_row("a", "2024-01-01T00:00:00")), _as_tuple(_row("b", "2024-01-02T00:00:00"))])
    source = _silver(spark, [_as_tuple(_row(k, t)) for k, t in
                             [("b", "2024-01-02T00:00:00"), ("c", "2024-01-02T00:00:00"),
                              ("d", "2024-01-03T00:00:00"), ("e", "2023-12-01T00:00:00"), ("f", None)]])
    inclusive = sorted(r.crash_record_id for r in incremental_delta(source, target, ["crash_record_id"]).collect())
    assert inclusive == ["c", "d"]  # c shares the mark's time and is kept; e is older; f has no time (dropped)
    strict = sorted(r.crash_record_id for r in
                    incremental_delta(source, target, ["crash_record_id"], strict=True).collect())
    assert strict == ["d"]
    empty_target = sorted(r.crash_record_id for r in incremental_delta(source, None, ["crash_record_id"]).collect())
    assert empty_target == ["b", "c", "d", "e"]


def test_unparsed_time_rows_are_loaded_once(spark):
    target = _silver(spark, [_as_tuple(_row("a", "2024-01-01T00:00:00"))])
    source = _silver(spark, [_as_tuple(_row("u", "garbage")), _as_tuple(_row("a", "2024-01-01T00:00:00"))])
    got = [r.crash_record_id for r in incremental_delta(source, target, ["crash_record_id"]).collect()]
    assert got == ["u"]
    assert incremental_delta(source, target.unionByName(source), ["crash_record_id"]).count() == 0


def test_load_twice_is_idempotent(spark, tmp_path, silver_crash_df):
    target = str(tmp_path / "silver")
    first = incremental_load(spark, silver_crash_df, target, SILVER_CRASH, ["crash_record_id"])
    assert first is not None
    n1 = read_table(spark, target, SILVER_CRASH).count()
    incremental_load(spark, silver_crash_df, target, SILVER_CRASH, ["crash_record_id"])
    n2 = read_table(spark, target, SILVER_CRASH).count()
    assert n1 == n2 == 6


def test_recent_only_prunes_but_agrees_for_immutable_times(spark):
    target = _silver(spark, [_as_tuple(_row("a", "2024-01-01T00:00:00")), _as_tuple(_row("b", "2024-02-01T00:00:00"))])
    source = _silver(spark, [_as_tuple(_row(k, t)) for k, t in
                             [("b", "2024-02-01T00:00:00"), ("c", "2024-02-02T00:00:00")]])
    full = incremental_delta(source, target, ["crash_record_id"])
    recent = incremental_delta(source, target, ["crash_record_id"], recent_only=True, lateness_seconds=86400)
    assert sorted(full.drop("ingestion_time").collect()) == sorted(recent.drop("ingestion_time").collect())


def test_recent_only_prunes_partitions(spark, silver_crash_df, tmp_path):
    path = str(tmp_path / "silver")
    incremental_load(spark, silver_crash_df, path, SILVER_CRASH, ["crash_record_id"])
    target = read_table(spark, path, SILVER_CRASH)
    delta = incremental_delta(silver_crash_df, target, ["crash_record_id"], recent_only=True)
    plan = delta._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.splitlines() if "PartitionFilters: [" in x and "PartitionFilters: []" not in x]
    assert any("month" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] for x in filters)
    assert delta.count() == 0


def test_file_stream_two_drops(spark, tmp_path):
    bronze = tmp_path / "bronze"
    target = str(tmp_path / "silver")
    ckpt = str(tmp_path / "ckpt")
    rows1 = [_row("a", "2024-01-01T00:00:00"), _row("b", "2024-01-02T00:00:00")]
    rows2 = [_row("b", "2024-01-02T00:00:00", "2024-03-11 00:00:00"), _row("c", "2024-01-03T00:00:00")]
    write_pages(bronze, "2024-03-10", "p1.json", rows1)

    def run():
        stream = read_bronze_stream(spark, f"{bronze}/*/*.json")
        stream_into_table(stream, silver_crashes, target, SILVER_CRASH, ["crash_record_id"], checkpoint_location=ckpt)
        return read_table(spark, target, SILVER_CRASH)

    assert run().count() == 2
    write_pages(bronze, "2024-03-11", "p2.json", rows2)
    out = run()
    assert sorted(r.crash_record_id for r in out.collect()) == ["a", "b", "c"]  # b not duplicated
    assert run().count() == 3  # nothing new: no change


def test_stream_matches_batch_silver(spark, tmp_path, bronze_dirs, silver_crash_df):
    crashes, _ = bronze_dirs
    target, ckpt = str(tmp_path / "s"), str(tmp_path / "c")
    stream_into_table(read_bronze_stream(spark, f"{crashes}/*/*.json"), silver_crashes, target, SILVER_CRASH,
                      ["crash_record_id"], checkpoint_location=ckpt)
    streamed = read_table(spark, target, SILVER_CRASH).drop("ingestion_time")
    assert len(CRASHES) == 10
    assert sorted(streamed.collect()) == sorted(silver_crash_df.drop("ingestion_time").collect())
    assert streamed.filter(F.col("crash_record_id") == "c1").count() == 1


def test_insert_only_differs_from_batch_latest_version(spark):
    """T1 ignores a later version of a stored key; the batch silver job keeps the latest."""
    v1 = _row("k", "2024-01-02T00:00:00", "2024-03-10 00:00:00")
    v2 = dict(_row("k", "2024-01-02T00:00:00", "2024-03-11 00:00:00"), weather_condition="SNOW")
    target = _silver(spark, [_as_tuple(v1)])
    later = _silver(spark, [_as_tuple(v2)])
    assert incremental_delta(later, target, ["crash_record_id"]).count() == 0
    batch = _silver(spark, [_as_tuple(v1), _as_tuple(v2)]).first()
    assert batch.weather_condition == "SNOW"
