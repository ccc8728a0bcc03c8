"""Dense stored ids, and the spatial layout."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq

from strata.functions.key_map import assign_ids, key_map
from strata.operators.clean import in_box
from strata.sources.spatial import write_clustered, z_order
from strata.sources.versions import Lake

KEY = ["latitude", "longitude"]


def test_ids_are_dense_unique_and_stay(spark, tmp_path):
    """Three runs over growing keys, nulls and repeated keys among them."""
    rng = random.Random(1)
    lake, base, known = Lake(spark, str(tmp_path / "lake")), None, {}
    keys = [(None, None), (1.0, None)]
    for run in range(3):
        keys += [(float(rng.randint(0, 20)), float(rng.randint(0, 20))) for _ in range(60)]
        df = spark.createDataFrame(keys, "latitude double, longitude double").repartition(5)
        base = lake.commit(base, {"ids": assign_ids(lake, base, "ids", df, KEY, "location_id")})
        rows = key_map(lake, "ids", df.schema.fields, "location_id").collect()
        ids = {(r.latitude, r.longitude): r.location_id for r in rows}
        assert len(rows) == len(ids) == len(set(keys)) and sorted(ids.values()) == list(range(1, len(ids) + 1))
        assert known.items() <= ids.items()
        new = sorted((k for k in ids if k not in known), key=lambda k: tuple((x is not None, x or 0) for x in k))
        assert [ids[k] for k in new] == list(range(len(known) + 1, len(ids) + 1))
        known = ids
    again = assign_ids(lake, base, "ids", df, KEY, "location_id")
    assert again == base.folders("ids")  # nothing new, nothing written


def test_z_order_interleaves(spark):
    rows = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(rows, "a long, b long")
    for r in df.select("a", "b", z_order([df.a, df.b]).alias("z")).collect():
        want = sum(((r.a >> i & 1) << 2 * i) | ((r.b >> i & 1) << 2 * i + 1) for i in range(3))
        assert r.z == want


def test_a_small_box_skips_row_groups(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.uniform(41, 42), rng.uniform(-88, -87)) for i in range(40_000)] + [(-1, None, -87.5), (-2, float("nan"), -87.5)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double").repartition(6)
    path = str(tmp_path / "clustered")
    write_clustered(df, path, group_bytes=40_000)
    box = (41.30, 41.35, -87.60, -87.55)
    back = spark.read.parquet(path)
    assert back.count() == len(rows)
    want = {i for i, a, o in rows if a is not None and box[0] <= a <= box[1] and box[2] <= o <= box[3]}
    assert {r.id for r in in_box(back, box).collect()} == want
    met = total = 0
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            total += 1
            near = True
            for column, lo, hi in ((1, *box[:2]), (2, *box[2:])):
                s = meta.row_group(g).column(column).statistics
                near &= s is None or not s.has_min_max or (s.min <= hi and s.max >= lo)
            met += near
    assert total >= 15 and met * 5 < total
    assert "GreaterThanOrEqual(latitude" in in_box(back, box)._jdf.queryExecution().toString()
