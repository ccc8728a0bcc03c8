"""Golden crash and video rows (FIXTURES.md), and bronze pages made of them."""

from __future__ import annotations

import json
from pathlib import Path

# Golden crash rows (FIXTURES.md §2); numbers partly as JSON numbers, partly as text,
# because bronze keeps whatever the API sent.
T1, T2 = "2024-03-10 08:00:00.000001", "2024-03-11 08:00:00.000001"
CRASHES = [
    {"crash_record_id": "c1", "crash_date": "2024-01-05T14:30:00.000", "weather_condition": "RAIN",
     "lighting_condition": "DARKNESS", "latitude": 41.90, "longitude": -87.60, "injuries_total": "1",
     "injuries_fatal": "0", "ingestion_time": T1, "first_crash_type": "REAR END", "roadway_surface_cond": "WET"},
    {"crash_record_id": "c1", "crash_date": "2024-01-05T14:30:00.000", "weather_condition": "RAIN",
     "lighting_condition": "DARKNESS", "latitude": 41.90, "longitude": -87.60, "injuries_total": "1",
     "injuries_fatal": "0", "ingestion_time": T2, "first_crash_type": "REAR END", "roadway_surface_cond": "WET"},
    {"crash_record_id": "c2", "crash_date": "2024-01-06T08:00:00.000", "weather_condition": "CLEAR",
     "lighting_condition": "DAYLIGHT", "latitude": "41.90", "longitude": "-87.60", "injuries_total": 0,
     "injuries_fatal": 0, "ingestion_time": T1, "first_crash_type": "ANGLE", "roadway_surface_cond": "DRY"},
    {"crash_record_id": "c3", "crash_date": "2024-01-07T22:10:00.000", "weather_condition": "SNOW",
     "lighting_condition": "DARKNESS, LIGHTED ROAD", "latitude": 41.9, "longitude": -87.6, "injuries_total": 2,
     "injuries_fatal": 1, "ingestion_time": T1, "first_crash_type": "REAR END", "roadway_surface_cond": "SNOW"},
    {"crash_record_id": "c4", "crash_date": "2024-02-01T06:45:00.000", "weather_condition": None,
     "lighting_condition": "DAWN", "latitude": 41.80, "longitude": -87.70, "injuries_total": 0,
     "injuries_fatal": 0, "ingestion_time": T1},
    {"crash_record_id": "c5", "crash_date": "2024-02-02T09:00:00.000", "weather_condition": "CLEAR",
     "lighting_condition": "DAYLIGHT", "latitude": None, "longitude": -87.70, "injuries_total": 0,
     "injuries_fatal": 0, "ingestion_time": T1},
    {"crash_record_id": None, "crash_date": "2024-02-03T09:00:00.000", "weather_condition": "CLEAR",
     "lighting_condition": "DAYLIGHT", "latitude": 41.80, "longitude": -87.70, "injuries_total": 0,
     "injuries_fatal": 0, "ingestion_time": T1},
    {"crash_record_id": "c6", "crash_date": None, "weather_condition": "CLEAR", "lighting_condition": "DAYLIGHT",
     "latitude": 41.80, "longitude": -87.70, "injuries_total": 0, "injuries_fatal": 0, "ingestion_time": T1},
    {"crash_record_id": "c7", "crash_date": "bad", "weather_condition": "CLEAR", "lighting_condition": "DAYLIGHT",
     "latitude": 41.80, "longitude": -87.70, "injuries_total": 0, "injuries_fatal": 0, "ingestion_time": T1},
    {"crash_record_id": "c8", "crash_date": "2024-03-01T00:00:00.000", "weather_condition": "FOG",
     "lighting_condition": "DUSK", "latitude": 10.0, "longitude": 10.0, "injuries_total": 0, "injuries_fatal": 0,
     "ingestion_time": T1},
]

VIDEOS_FLAT = [
    {"video_id": "v1", "title": "a", "channel": "ch", "published_at": "2024-01-10T00:00:00Z", "query": "q1",
     "ingestion_time": T1},
    {"video_id": "v1", "title": "a", "channel": "ch", "published_at": "2024-01-10T00:00:00Z", "query": "q2",
     "ingestion_time": T1},
    {"video_id": "v2", "title": "b", "channel": "ch", "published_at": "2024-01-31T23:59:59Z", "query": "q1",
     "ingestion_time": T1},
    {"video_id": "v3", "title": "c", "channel": "ch", "published_at": "2024-04-01T00:00:00Z", "query": "q3",
     "ingestion_time": T1},
    {"video_id": None, "title": "d", "channel": "ch", "published_at": "2024-04-01T00:00:00Z", "query": "q3",
     "ingestion_time": T1},
]


def nested(v: dict) -> dict:
    return {"kind": "search#result", "id": {"videoId": v["video_id"]},
            "snippet": {"title": v["title"], "channelTitle": v["channel"], "publishedAt": v["published_at"]},
            "ingestion_time": v["ingestion_time"]}


def write_pages(root: Path, day: str, name: str, rows: list[dict]) -> Path:
    d = root / day
    d.mkdir(parents=True, exist_ok=True)
    p = d / name
    p.write_text(json.dumps(rows, indent=2))
    return p
