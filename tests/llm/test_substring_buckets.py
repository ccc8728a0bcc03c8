"""A frequent minimiser does not make one large bucket."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import substrings
from strata.llm.words import split

BUCKETS = 40


@pytest.fixture(scope="module")
def common_pair(spark):
    """Random texts that all hold one pair of words of the least hash, before every eighth word, and a few repeats."""
    rng = random.Random(8)
    pairs = [f"a{i} b{i}" for i in range(20_000)]
    least = substrings.minimisers(split([" ".join(pairs).encode()]).hashes(), substrings.M)[::2]
    pair = pairs[int(np.argmin(least))]
    rows = []
    for i in range(200):
        words = []
        for j in range(400):
            words += [pair] if j % 8 == 0 else [f"x{rng.randrange(10**6)}"]
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, "new words " + " ".join(rows[i][1].split()[20 : 60 + i])) for i in range(20)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_buckets_of_a_frequent_minimiser_stay_even(common_pair):
    _, docs = common_pair
    docs = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__key"), F.col("text").alias("__text"))
    words = collections.Counter()
    for row in substrings.dealt(docs, substrings.WINDOW, BUCKETS).collect():
        kind, *_, body = substrings._unpack(bytes(row.packed))
        if kind == 0:
            words[row.bucket] += len(body.split())
    assert max(words.values()) < 3 * sum(words.values()) / BUCKETS


def test_repeats_in_windows_of_a_frequent_minimiser(common_pair):
    rows, docs = common_pair
    first = {}
    for i, text in rows:
        words = text.split()
        for k in range(len(words) - 12):
            first.setdefault(tuple(words[k : k + 13]), i)
    want = {}
    for i, text in rows:
        words = text.split()
        gone = set()
        for k in range(len(words) - 12):
            if first[tuple(words[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        want[i] = len(gone)
    assert sum(want.values())
    assert {r.doc_id: r.n_removed for r in substrings.digests(docs).collect()} == want


def test_equal_windows_get_equal_keys_at_every_level():
    text = split([b"p q r s t u v w x y z a b c d", b"k p q r s t u v w x y z a b c d e f"])
    hashes = text.hashes()
    none = np.zeros(0, np.uint64)
    all_ = substrings.minimisers(hashes, 13)
    longer = substrings.minimisers(hashes, 13, substrings.LONGER)
    seen = []
    for frequent in ((none, none), (all_, none), (all_, longer)):
        keys = substrings._keys(hashes, 13, frequent)
        second = text.first[1] + 1  # the same words begin there
        assert keys[:3].tolist() == keys[second : second + 3].tolist()
        seen.append(keys[0])
    assert len(set(seen)) == 3
