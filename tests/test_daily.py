"""The daily load: lake versions, landing log, key index, keyed upsert, incremental gold."""

from __future__ import annotations

import dataclasses
import datetime
import random

import pytest
from crash_rows import write_pages

from strata import schemas as S
from strata.operators.dedup import latest_per_key
from strata.plans import daily, gold, silver, warehouse
from strata.sources.bronze import read_bronze_crashes, read_bronze_videos
from strata.sources.lake import MissingTable
from strata.sources.versions import Lake, StaleVersion, partition_of


def crash(key, day, **more):
    row = {"crash_record_id": key, "crash_date": f"2024-{day}T10:00:00.000", "weather_condition": "RAIN", "lighting_condition": "DAYLIGHT",
           "latitude": "41.9", "longitude": "-87.6", "injuries_total": "1", "injuries_fatal": "0", "ingestion_time": "2024-06-01 00:00:00"}
    return row | more


def video(key, day, **more):
    return {"video_id": key, "title": "t", "channel": "c", "published_at": f"2024-{day}T00:00:00Z", "ingestion_time": "2024-06-01 00:00:00"} | more


def plain(df):
    return sorted(map(str, df.drop("ingestion_time", "source", "batch_id").collect()))


def rebuilt(spark, crashes, videos):
    """All tables by a full build over everything that landed."""
    c = silver.silver_crashes(read_bronze_crashes(spark, f"{crashes}/*/*.json"))
    v = silver.silver_videos(read_bronze_videos(spark, str(videos)))
    hot = gold.hotspots(c)
    risk = gold.risk_index(c)
    return {"silver_crashes": c, "silver_videos": v, "hotspots": hot, "risk_index": risk, "monthly": gold.monthly(c, v)}


def rebuilt_warehouse(spark, crashes):
    c = silver.silver_crashes(read_bronze_crashes(spark, f"{crashes}/*/*.json"))
    hot, risk = gold.hotspots(c), gold.risk_index(c)
    return {"dim_location": warehouse.dim_location(hot), "dim_risk": warehouse.dim_risk(risk), "dim_risk_level": warehouse.risk_level_dim(spark),
            "fact_accidents": warehouse.fact_accidents(hot, risk), "fact_crashes": warehouse.star_fact(c, risk)}


def assert_equal(spark, root, crashes, videos):
    lake = Lake(spark, root)
    for name, want in rebuilt(spark, crashes, videos).items():
        got = daily.load(lake, name)
        assert plain(got.select(*[c for c in want.columns])) == plain(want), name


@pytest.fixture()
def places(tmp_path):
    crashes, videos = tmp_path / "crashes", tmp_path / "videos"
    write_pages(crashes, "2024-06-01", "c1.json", [crash("a", "01-05"), crash("b", "01-06"), crash("c", "02-01", latitude=None)])
    write_pages(videos, "2024-06-01", "v1.json", [video("v1", "01-05"), video("v2", "03-01")])
    return str(tmp_path / "lake"), crashes, videos


def test_runs_equal_the_full_build(spark, places):
    """New, late, corrected, moved and dropped keys over six runs; one of them brings nothing."""
    root, crashes, videos = places
    assert daily.daily_load(spark, root, str(crashes), str(videos))["silver_crashes"] == 3
    assert_equal(spark, root, crashes, videos)
    later = {"ingestion_time": "2024-06-02 00:00:00"}
    write_pages(crashes, "2024-06-02", "c2.json", [
        crash("a", "01-05", weather_condition="CLEAR", **later),  # corrected
        crash("b", "03-09", **later),  # moved to another month
        crash("c", "02-01", **later),  # coordinates at last
        crash("d", "12-31", **later), crash(None, "01-01"), crash("e", None, crash_date="bad"), crash("f", None, crash_date=None)])
    daily.daily_load(spark, root, str(crashes), str(videos))
    assert_equal(spark, root, crashes, videos)
    before = Lake(spark, root).version().number
    assert not any(daily.daily_load(spark, root, str(crashes), str(videos)).values())
    assert Lake(spark, root).version().number == before
    # late: an older version of a stored key, in a folder that was read before
    write_pages(crashes, "2024-06-01", "c3.json", [crash("a", "01-05", weather_condition="FOG"), crash("g", "01-05", ingestion_time=None)])
    write_pages(videos, "2024-06-03", "v2.json", [video("v1", "02-05", **later), video("v3", "12-30"), video(None, "01-01")])
    daily.daily_load(spark, root, str(crashes), str(videos))
    assert_equal(spark, root, crashes, videos)
    # a row that loses its coordinates leaves silver and gold
    write_pages(crashes, "2024-06-04", "c4.json", [crash("d", "12-31", longitude=None, ingestion_time="2024-06-04 00:00:00"),
                                                   crash("g", "01-05", ingestion_time="2024-06-04 00:00:00", lighting_condition="DARKNESS")])
    daily.daily_load(spark, root, str(crashes), str(videos))
    assert_equal(spark, root, crashes, videos)
    rng = random.Random(4)
    write_pages(crashes, "2024-06-05", "c5.json", [
        crash(rng.choice("abcdefghijkl"), f"{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", injuries_total=str(i),
              latitude=rng.choice(["41.9", "41.8", None]), weather_condition=rng.choice(["RAIN", "CLEAR", None]),
              ingestion_time=f"2024-06-0{rng.randint(1, 7)} 00:00:00") for i in range(60)])
    daily.daily_load(spark, root, str(crashes), str(videos))
    assert_equal(spark, root, crashes, videos)


def test_backlog_in_bounded_steps(spark, places):
    root, crashes, videos = places
    for i in range(5):
        write_pages(crashes, f"2024-06-1{i}", "c.json", [crash(f"k{i}", "05-05"), crash("a", "01-05", ingestion_time=f"2024-06-1{i} 00:00:00")])
    runs = 0
    while any(daily.daily_load(spark, root, str(crashes), str(videos), max_files=2).values()):
        runs += 1
    assert runs == 3
    assert_equal(spark, root, crashes, videos)


def test_only_new_files_and_near_months_are_read(spark, places, monkeypatch):
    root, crashes, videos = places
    daily.daily_load(spark, root, str(crashes), str(videos))
    read = []

    def watched(spark, paths, *args, **kwargs):
        read.extend(paths)
        return read_bronze_crashes(spark, paths, *args, **kwargs)

    monkeypatch.setattr(daily, "CRASHES", dataclasses.replace(daily.CRASHES, read=watched))
    write_pages(crashes, "2024-06-02", "c2.json", [crash("a", "01-05", weather_condition="CLEAR", ingestion_time="2024-07-01 00:00:00"),
                                                   crash("z", "07-01")])
    before = Lake(spark, root).version()
    daily.daily_load(spark, root, str(crashes), str(videos))
    after = Lake(spark, root).version()
    assert [p.rpartition("/")[2] for p in read] == ["c2.json"]
    untouched = {"year=2024/month=2", "year=2024/month=1"}
    for table, same in (("hotspots", {"year=2024/month=2"}), ("silver_crashes_state", {"year=2024/month=2"}), ("silver_videos", untouched)):
        assert after.folders(table, same) == before.folders(table, same), table
    assert {partition_of(f) for f in after.folders("hotspots")} == {"year=2024/month=1", "year=2024/month=7"}


def test_key_index_prunes_and_is_exact(spark, places):
    root, crashes, videos = places
    rows = [crash(f"k{m}-{i}", f"{m:02d}-10") for m in range(1, 13) for i in range(20)]
    write_pages(crashes, "2024-06-02", "c2.json", rows)
    daily.daily_load(spark, root, str(crashes), str(videos))
    lake = Lake(spark, root)
    base = lake.version()
    delta = spark.createDataFrame([("k3-1",), ("k3-7",), ("k9-0",), ("new-1",), ("new-2",)], "crash_record_id string")
    index = lake.read("silver_crashes_keys", S.KEY_INDEX, base)
    assert daily.months_of(index, delta, "crash_record_id") == ["year=2024/month=3", "year=2024/month=9"]
    absent = daily.keys_absent(lake, daily.CRASHES, base, delta)
    assert sorted(r[0] for r in absent.collect()) == ["new-1", "new-2"]
    state = lake.read("silver_crashes_state", daily.CRASHES.state_schema(spark), base, ["year=2024/month=3"])
    assert {f.split("month=")[1].split("/")[0] for f in state.inputFiles()} == {"3"}


def test_a_killed_run_changes_nothing(spark, places):
    root, crashes, videos = places
    daily.daily_load(spark, root, str(crashes), str(videos))
    lake = Lake(spark, root)
    before, rows = lake.version(), plain(daily.load(lake, "silver_crashes"))
    write_pages(crashes, "2024-06-02", "c2.json", [crash("a", "04-05", ingestion_time="2024-07-01 00:00:00"), crash("n", "05-05")])

    def killed():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        daily.daily_load(spark, root, str(crashes), str(videos), before_commit=killed)
    assert lake.version() == before and plain(daily.load(lake, "silver_crashes")) == rows
    daily.daily_load(spark, root, str(crashes), str(videos))
    assert_equal(spark, root, crashes, videos)
    assert lake.expire(keep=1) > 0  # the killed run's folders, and those that were replaced
    assert_equal(spark, root, crashes, videos)
    with pytest.raises(MissingTable):
        lake.version(before.number)


def test_insert_only_keeps_stored_keys(spark, places):
    root, crashes, videos = places
    daily.daily_load(spark, root, str(crashes), str(videos))
    write_pages(crashes, "2024-06-02", "c2.json", [crash("a", "04-05", ingestion_time="2024-07-01 00:00:00"), crash("n", "05-05")])
    assert daily.daily_load(spark, root, str(crashes), str(videos), upsert=False)["silver_crashes"] == 1
    rows = {r.crash_record_id: r.month for r in daily.load(Lake(spark, root), "silver_crashes").collect()}
    assert rows == {"a": 1, "b": 1, "n": 5}


def test_readers_keep_their_version_and_writers_collide(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.version() is None
    with pytest.raises(MissingTable):
        lake.read("t", S.HOTSPOTS)
    rows = spark.createDataFrame([(1.0, 2.0, 3, 2024, 1), (1.0, 2.0, 4, None, None)], S.HOTSPOTS)
    one = lake.commit(None, {"t": lake.stage(rows, "t", ["year", "month"])})
    two = lake.commit(one, {"t": lake.stage(rows.limit(1), "t", ["year", "month"])}, {"why": "smaller"})
    assert lake.read("t", S.HOTSPOTS, one).count() == 2 and lake.read("t", S.HOTSPOTS).count() == 1
    assert {(r.year, r.month) for r in lake.read("t", S.HOTSPOTS, one).collect()} == {(2024, 1), (None, None)}
    assert lake.version().properties == {"why": "smaller"} and two.number == 2
    with pytest.raises(StaleVersion):
        lake.commit(one, {"t": []})
    assert lake.version() == two
    for _ in range(4):
        base = lake.version()
        lake.commit(base, {"t": base.folders("t") + lake.stage(rows, "t", ["year", "month"])})
    want = sorted(map(str, lake.read("t", S.HOTSPOTS).collect()))
    assert lake.compact("t", S.HOTSPOTS, ["year", "month"], batches=2) is not None
    assert sorted(map(str, lake.read("t", S.HOTSPOTS).collect())) == want and len(lake.version().folders("t")) == 2
    assert lake.compact("t", S.HOTSPOTS, ["year", "month"], batches=2) is None
    assert lake.expire(keep=1) > 0
    assert sorted(map(str, lake.read("t", S.HOTSPOTS).collect())) == want


def test_warehouse_of_a_version(spark, places):
    """The warehouse tables equal those of a full build; a reader of an old version keeps its own."""
    root, crashes, videos = places
    daily.daily_load(spark, root, str(crashes), str(videos))
    lake = Lake(spark, root)
    old, rows = lake.version(), {t: plain(daily.load(lake, t)) for t in daily.WAREHOUSE}
    write_pages(crashes, "2024-06-02", "c2.json", [
        crash("a", "01-05", latitude="41.8", ingestion_time="2024-06-02 00:00:00"), crash("n", "05-05"), crash("m", None, crash_date="bad")])
    daily.daily_load(spark, root, str(crashes), str(videos))
    for name, want in rebuilt_warehouse(spark, crashes).items():
        got = daily.load(lake, name)
        assert plain(got.select(*want.columns)) == plain(want), name
    assert {t: plain(daily.load(lake, t, old)) for t in daily.WAREHOUSE} == rows


def test_rebuild_swaps_all_tables_at_once(spark, places):
    """A rebuild forgets rows of files that are gone, is seen only when whole, and yields to a load that came between."""
    root, crashes, videos = places
    for i in range(3):
        write_pages(crashes, f"2024-06-1{i}", "c.json", [crash(f"k{i}", "05-05"), crash("a", "01-05", ingestion_time=f"2024-06-1{i} 00:00:00")])
    while any(daily.daily_load(spark, root, str(crashes), str(videos), max_files=2).values()):
        pass
    lake = Lake(spark, root)
    before, rows = lake.version(), plain(daily.load(lake, "silver_crashes"))
    (crashes / "2024-06-11" / "c.json").unlink()  # a landing is withdrawn: only a rebuild can take its rows back

    def killed():
        assert lake.version() == before and plain(daily.load(lake, "silver_crashes")) == rows
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        daily.rebuild_lake(spark, root, str(crashes), str(videos), max_files=2, before_commit=killed)
    assert lake.version() == before and plain(daily.load(lake, "silver_crashes")) == rows
    total = daily.rebuild_lake(spark, root, str(crashes), str(videos), max_files=2)
    assert total["silver_crashes_files"] == 3 and lake.version().number == before.number + 1
    assert_equal(spark, root, crashes, videos)
    assert plain(daily.load(lake, "silver_crashes", before)) == rows
    assert not any(daily.daily_load(spark, root, str(crashes), str(videos)).values())
    write_pages(crashes, "2024-06-20", "c.json", [crash("late", "06-06")])
    with pytest.raises(StaleVersion):
        daily.rebuild_lake(spark, root, str(crashes), str(videos),
                           before_commit=lambda: daily.daily_load(spark, root, str(crashes), str(videos)))
    assert_equal(spark, root, crashes, videos)


def test_rebuild_of_nothing_leaves_empty_tables(spark, places, tmp_path):
    root, crashes, videos = places
    daily.daily_load(spark, root, str(crashes), str(videos))
    for name in ("c1.json", "v1.json"):
        for f in tmp_path.rglob(name):
            f.unlink()
    assert not any(daily.rebuild_lake(spark, root, str(crashes), str(videos)).values())
    lake = Lake(spark, root)
    for name in ("silver_crashes", "silver_videos", "hotspots", "risk_index", "monthly", "fact_accidents", "fact_crashes"):
        assert daily.load(lake, name).count() == 0, name


def test_malformed_records_are_kept_with_their_file(spark, places):
    root, crashes, videos = places
    (crashes / "2024-06-02").mkdir()
    (crashes / "2024-06-02" / "bad.json").write_text('[{"crash_record_id": "x", ')
    daily.daily_load(spark, root, str(crashes), str(videos))
    lake = Lake(spark, root)
    kept = daily.load(lake, "quarantine").collect()
    assert [(r.feed, r.path.rpartition("/")[2]) for r in kept] == [("silver_crashes", "bad.json")] and kept[0].record
    write_pages(videos, "2024-06-03", "v2.json", [video("v9", "02-05"), {"id": 5, "title": "odd shape"}])
    daily.daily_load(spark, root, str(crashes), str(videos))
    assert sorted((r.feed, r.n_rows, r.n_read) for r in daily.load(lake, "quarantine").collect()) == [
        ("silver_crashes", 1, 0), ("silver_videos", 2, 2)]  # the page's other row is read, and kept in silver
    assert "v9" in {r.video_id for r in daily.load(lake, "silver_videos").collect()}
    assert {r.crash_record_id for r in daily.load(lake, "silver_crashes").collect()} == {"a", "b"}


def test_a_lake_without_a_version_has_no_table(spark, tmp_path):
    with pytest.raises(MissingTable):
        daily.load(Lake(spark, str(tmp_path / "lake")), "fact_crashes")


def test_changed_rows_choose_as_the_full_build_does(spark):
    """One join finds what the dedup of both sides and its comparison with the stored rows find, nulls and ties included."""
    rnd = random.Random(5)
    schema = "crash_record_id string, crash_date string, latitude string, _ingested timestamp, year int, month int"
    times = [None, datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)]
    side = lambda lo: [(f"k{i}", rnd.choice(["a", "b"]), rnd.choice([None, "1", "2"]), rnd.choice(times), 2024, rnd.choice([None, 1, 2])) for i in range(lo, lo + 300)]
    stored, fresh = side(0), side(100)
    old, new = spark.createDataFrame(stored, schema), spark.createDataFrame(fresh, schema)
    best = {r.crash_record_id: tuple(r) for r in latest_per_key(old.union(new), ["crash_record_id"], prefer=["_ingested"]).collect()}
    had = {r[0]: r for r in stored}
    want = {k: (best[k], had.get(k)) for k in (r[0] for r in fresh) if best[k] != had.get(k)}
    fields = old.columns
    got = {r.crash_record_id: (tuple(r[c] for c in fields), r._old and (r.crash_record_id, *[r._old[c] for c in fields[1:]]))
           for r in daily.changed_rows(old, new, "crash_record_id").collect()}
    assert got == want and 200 < len(got) < 300
    assert {r.crash_record_id for r in daily.changed_rows(old, new, "crash_record_id", upsert=False).collect()} == {f"k{i}" for i in range(300, 400)}


def test_a_load_writes_its_rows_to_scratch_twice_at_most(spark, places, monkeypatch):
    root, crashes, videos = places
    daily.daily_load(spark, root, str(crashes), str(videos))
    written, write = [], daily._written
    monkeypatch.setattr(daily, "_written", lambda df, name: written.append(name) or write(df, name))
    write_pages(crashes, "2024-06-02", "c2.json", [crash("a", "04-05", ingestion_time="2024-07-01 00:00:00"), crash("n", "05-05")])
    daily.daily_load(spark, root, str(crashes), str(videos))
    assert [n for n in written if n.startswith("silver_crashes")] == ["silver_crashes-fresh", "silver_crashes-won"]
    assert_equal(spark, root, crashes, videos)
