from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from crash_rows import CRASHES, VIDEOS_FLAT, write_pages  # noqa: E402

from strata.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="strata-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def bronze_dirs(tmp_path: Path):
    crashes = tmp_path / "bronze" / "crashes"
    videos = tmp_path / "bronze" / "videos"
    write_pages(crashes, "2024-03-10", "crash_1.json", CRASHES[:5])
    write_pages(crashes, "2024-03-11", "crash_2.json", CRASHES[5:])
    write_pages(videos, "2024-03-10", "video_1.json", VIDEOS_FLAT)
    return crashes, videos


@pytest.fixture()
def silver_crash_df(spark, bronze_dirs):
    from strata.plans.silver import silver_crashes
    from strata.sources.bronze import read_bronze_crashes

    crashes, _ = bronze_dirs
    return silver_crashes(read_bronze_crashes(spark, f"{crashes}/*/*.json"))


@pytest.fixture()
def silver_video_df(spark, bronze_dirs):
    from strata.plans.silver import silver_videos
    from strata.sources.bronze import read_bronze_videos

    _, videos = bronze_dirs
    return silver_videos(read_bronze_videos(spark, str(videos)))
