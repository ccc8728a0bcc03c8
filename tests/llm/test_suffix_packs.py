"""What the byte-exact dedup moves: few packs, few bytes, whole texts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import suffix_dedup


def _texts(n: int, words: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    return [" ".join(vocabulary[int(rng.paretovariate(0.6)) % 3000] for _ in range(words)) for _ in range(n)]


def test_a_task_sends_one_pack_a_bucket_and_few_bytes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 100_000)
    texts = _texts(300, 700, 1)
    ids = np.arange(300) * 7 + 10**9
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.zeros(300, np.int64)), pa.array(texts)], names=["__id", "__key", "__text"])
    none = np.zeros(0, np.uint64)
    rows = [(b, x) for out in suffix_dedup._packs(iter([batch]), 100, 50, (none, none)) for b, x in zip(*(c.to_pylist() for c in out.columns))]
    parts = [suffix_dedup._unpack(x) for _, x in rows]
    sent = [p for p in parts if p[0] == 0]
    assert len(sent) <= 50  # one for each bucket, not one for each bucket and chunk
    # every string is as it stood in its text
    n = 0
    at = {i: t.encode() for i, t in zip(ids.tolist(), texts)}
    for _, (own, keys, places, _, sizes, _, _), body in sent:
        end = np.cumsum(sizes.astype(np.int64))
        for i, key, place, size, z in zip(own.tolist(), keys.tolist(), places.tolist(), sizes.tolist(), end.tolist()):
            assert key == 0 and body[z - size : z] == at[i][place : place + size]
            n += 1
    raw = sum(len(p[2]) for p in sent)
    columns = sum(len(x) for _, x in rows) - len(suffix_dedup.zstandard.ZstdCompressor(level=3).compress(b"".join(p[2] for p in sent)))
    assert n > 10_000 and raw > 3 * sum(map(len, texts))
    assert columns < 9 * n  # bytes a string beside its text; 4 of a minimiser's hash are found again from the text


def test_long_texts_stay_whole(spark):
    passage = "a passage of more than a hundred bytes that stands in several texts, long and short ones, é 中文 🙂, once each; "
    body = _texts(4, 400, 2)
    rows = [(1, body[0] + passage + body[1]), (2, passage), (3, None), (4, ""), (5, "z" * 5000), (6, body[2] + passage), (7, passage + "short"),
            (8, "x" * 1023), (9, "y" * 1024)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("kept").alias("more"))
    assert docs.schema["more"].nullable is False
    seen = {r.doc_id: r for r in suffix_dedup.dedup(docs).collect()}
    assert {i: (r.text, r.more) for i, r in seen.items()} == {i: (t, "kept") for i, t in rows}
    assert seen[1]["__n_removed"] == 0 and seen[2]["__n_removed"] == len(passage.encode()) and seen[3]["__n_bytes"] == 0
    assert bytes(seen[6]["__kept"]).decode().startswith(body[2][:-1]) and seen[6]["__n_bytes"] == len(rows[5][1].encode())
    assert (seen[5]["__n_removed"], seen[5]["__n_spans"]) == (4999, 1) and seen[8]["__n_removed"] == 1022
