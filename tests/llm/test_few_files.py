"""Small intermediate rows are written to few files, whatever the number of shuffle partitions."""

from __future__ import annotations

import random
from pathlib import Path
from urllib.parse import urlparse

import pytest

from strata.llm import components, jaccard
from strata.session import ensure_checkpoint_dir

PARTITIONS = 96
SETTINGS = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def dealt_wide(spark):
    """Every shuffle has ``PARTITIONS`` partitions, as on a large input; gives the files of new scratch tables by name."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    top = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    old = set(top.iterdir())

    def written(name: str) -> list[int]:
        return [len(list(p.glob("part-*.parquet"))) for p in set(top.iterdir()) - old if p.name.startswith(name)]

    yield written
    for k, v in before.items():
        spark.conf.set(k, v)


def _most(spark) -> int:
    return max(spark.sparkContext.defaultParallelism, PARTITIONS // 16)


def test_rounds_of_components_write_few_files(spark, dealt_wide):
    rng = random.Random(3)
    edges = [(rng.randrange(900), rng.randrange(900)) for _ in range(700)] + [(0, i) for i in range(1000, 1300)]
    root = {n: n for e in edges for n in e}

    def top(n: int) -> int:
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: top(n) for e in edges if e[0] != e[1] for n in e}
    files = dealt_wide("component-edges")
    assert len(files) > 1 and max(files) <= _most(spark)


def test_jaccard_writes_few_files(spark, dealt_wide):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):  # one group of near copies, larger than a small bucket, and a text of its own each
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(f"y{rng.randrange(10**9)}" for _ in range(20)))]
    found = {r.doc_id: r for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    for i, own in sets.items():
        links = sum(len(own & s) >= 0.8 * len(own | s) for j, s in sets.items() if j != i and (i + j) % 2 == 0)
        assert (found[i].class_id, found[i].n_links) == (0 if i % 2 == 0 else i, links)
    for name in ("jaccard-representatives", "jaccard-buckets", "jaccard-groups", "component-edges"):
        files = dealt_wide(name)
        assert files and max(files) <= _most(spark), name
