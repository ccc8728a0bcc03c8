"""Large buckets of near copies keep all their paths over the levels."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import jaccard
from strata.llm.common import stored


def test_long_near_copies_are_all_linked(spark):
    """100 one-word versions of a 20,000-word text, from several seeds: their sketches are nearly all equal."""

    def versions(batches):
        for batch in batches:
            for seed in batch.column("id").to_pylist():
                rng = random.Random(seed)
                words = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
                for i in range(100):
                    own = [*words[: i * 199], f"changed{i}", *words[i * 199 + 1 :]]
                    yield pa.RecordBatch.from_pydict({"doc_id": [100 * seed + i], "text": [" ".join(own)]})

    docs = stored(spark.range(6).repartition(6, "id").mapInArrow(versions, "doc_id long, text string").repartition(8), "near-copies")
    found = jaccard.join(docs).groupBy("class_id").agg(F.count("*").alias("n"), F.min("n_links").alias("links")).collect()
    assert sorted((r.class_id, r.n, r.links) for r in found) == [(100 * seed, 100, 99) for seed in range(6)]
