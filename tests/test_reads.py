"""Paged reads, kept results, and the scan that reports what it skipped."""

from __future__ import annotations

import datetime

import pytest

from strata.operators.cursor import Position, page, pages
from strata.sources.cache import ResultCache, fingerprint
from strata.sources.scan_report import read_reporting

T = [datetime.datetime(2024, 1, d) for d in (1, 2, 3)]


@pytest.mark.parametrize("n", [2, 5, 100])
def test_pages_lose_and_repeat_nothing(spark, n):
    """Ties at every border, nulls in both sort columns, rows equal in all columns."""
    rows = [(t, k, v) for t in [*T, None] for k in ("a", "b", None) for v in (1, 1, 2, None)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string, v int").repartition(3)
    order = [F_.asc_nulls_last() for F_ in (df.t, df.k, df.v)]
    want = [tuple(r) for r in df.orderBy(*order).collect()]
    got, last = [], None
    for part, after in pages(df, ["t", "k"], n):
        own = [tuple(r) for r in part.collect()]
        assert 0 < len(own) <= n
        got += sorted(own, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))
        # a position kept as text goes on just where it stopped
        resumed = [tuple(r) for r in page(df, ["t", "k"], n, Position.of(after.token)).collect()]
        assert resumed == want[len(got) : len(got) + n]
        last = after
    assert got == want
    assert page(df, ["t", "k"], n, last).isEmpty()


def test_page_reads_rows_that_came_after_the_position(spark):
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "t int, k string")
    _, after = list(pages(first, ["t", "k"], 10))[-1]
    more = first.union(spark.createDataFrame([(2, "b"), (3, None)], "t int, k string"))
    assert [tuple(r) for r in page(more, ["t", "k"], 10, after).collect()] == [(2, "b"), (3, None)]


def test_results_expire_and_follow_the_version(spark, tmp_path):
    now, built = [1000.0], []

    def build(n):
        built.append(n)
        return spark.range(n).selectExpr("id", "cast(null as int) as year")

    cache = ResultCache(spark, str(tmp_path / "results"), ttl=60, clock=lambda: now[0])
    ask = lambda version, n, **params: cache.get("r", version, lambda: build(n), params, ["year"]).count()
    assert ask(1, 3) == 3 and ask(1, 4) == 3 and built == [3]
    assert cache.get("r", 1, lambda: build(9), {}, ["year"]).schema["year"].dataType.simpleString() == "int"
    assert ask(1, 5, top=2) == 5  # another question
    now[0] += 59
    assert ask(1, 6) == 3
    now[0] += 1
    assert ask(1, 7) == 7  # expired
    assert ask(2, 8) == 8  # a new version
    assert ask(1, 9) == 7 and built == [3, 5, 7, 8]
    held = cache.get("r", 2, lambda: build(0), {}, ["year"])
    now[0] += 120
    assert ask(2, 1) == 1
    again = ResultCache(spark, str(tmp_path / "results"), ttl=60, clock=lambda: now[0])
    assert again.get("r", 2, lambda: build(0), {}, ["year"]).count() == 1  # another session finds it
    with pytest.raises(Exception):
        held.count()  # two lives are over


def test_fingerprint_follows_files(spark, tmp_path):
    for i in range(2):
        spark.range(5).write.parquet(str(tmp_path / f"t{i}"))
    paths = [str(tmp_path / "t0"), str(tmp_path / "t1")]
    one = fingerprint(spark, paths)
    assert one == fingerprint(spark, paths[::-1])
    spark.range(1).write.mode("append").parquet(paths[1])
    assert fingerprint(spark, paths) != one


def test_scan_names_what_it_skipped(spark, tmp_path):
    """A good file, a bad footer, a truncated file, a bad page in one of two row groups, another schema, no row."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    root = tmp_path / "t"
    (root / "sub").mkdir(parents=True)
    table = pa.table({"id": pa.array(range(2000), pa.int64()), "name": [f"name {i}" for i in range(2000)]})
    pq.write_table(table, root / "good.parquet")
    (root / "footer.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    whole = (root / "good.parquet").read_bytes()
    (root / "sub" / "truncated.parquet").write_bytes(whole[: len(whole) // 2])
    pq.write_table(table, root / "sub" / "page.parquet", row_group_size=1000, compression="snappy", use_dictionary=False)
    bad = bytearray((root / "sub" / "page.parquet").read_bytes())
    bad[200:4000] = b"\xff" * 3800
    (root / "sub" / "page.parquet").write_bytes(bytes(bad))
    pq.write_table(pa.table({"id": pa.array([7], pa.int32()), "other": ["x"]}), root / "narrow.parquet")
    pq.write_table(table.slice(0, 0), root / "empty.parquet")
    schema = spark.createDataFrame([], "id long, name string").schema
    rows, report = read_reporting(spark, str(root), schema)
    by = {r.path.rpartition("/")[2]: r for r in report.collect()}
    assert {n: (r.rows_read, r.rows_lost, r.error is None) for n, r in by.items()} == {
        "good.parquet": (2000, 0, True), "footer.parquet": (0, None, False), "truncated.parquet": (0, None, False),
        "page.parquet": (1000, 1000, False), "narrow.parquet": (1, 0, True), "empty.parquet": (0, 0, True)}
    assert rows.count() == 3001 and rows.where("name is null").collect()[0].id == 7
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != "1"


def test_pages_sort_the_table_once(spark):
    """A page reads its own rows, not the table again; pages fetched together are numbered alike."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.range(100, numPartitions=2).selectExpr("cast(id % 40 as int) as t", "id as k").mapInArrow(seen, "t int, k long")
    want = [tuple(r) for r in spark.range(100).selectExpr("cast(id % 40 as int) as t", "id as k").orderBy("t", "k").collect()]
    parts = list(pages(df, ["t", "k"], 5))
    assert [tuple(r) for rows, _ in parts for r in rows.collect()] == want and len(parts) == 20
    assert read.value <= 2 * 100  # a sample for the ranges, then the sort
    runs = list(pages(df, ["t", "k"], 5, parts[2][1], at_once=7, number="page"))
    assert len(runs) == 3 and runs[-1][1] == parts[-1][1]
    assert [tuple(r) for rows, _ in runs for r in rows.collect()] == [(*r, i // 5 + 1) for i, r in enumerate(want[15:])]


def test_stored_silver_is_built_from_small_splits(spark, tmp_path, monkeypatch):
    """The dedup sorts what a task reads, so the build bounds it; the setting is as before afterwards."""
    import __spark_entry__ as E

    name, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    spark.range(3).write.parquet(str(tmp_path / "lineitem.parquet"))

    def build(s, sf):
        seen.append(int(s.conf.get(name)))
        return s.range(3).selectExpr("id", "2024 as year", "1 as month")

    assert E._stored(spark, str(tmp_path), "silver-crashes", build).count() == 3
    assert seen == [32 << 20] and spark.conf.get(name) == before
