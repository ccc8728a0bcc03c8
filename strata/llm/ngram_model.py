"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays.

Counting has two passes over the training texts. The first sums the words (by 64-bit hash). The
second sums the word pairs: each chunk of texts packs its distinct pairs with their counts and sends
them to the bucket of the first word; pairs of a word that many pairs begin with are spread over all
buckets, so no bucket depends on one word. A bucket writes its pairs as a sorted array of hashes
with their counts, and returns what the model needs from it: counts of counts, how many different
words stand before each word, and how many followers of each word were seen once, twice, or more.
The words with these numbers are written as sorted arrays in shards of the hash.

Workers memory-map all arrays from the shared checkpoint folder and look up the sorted hashes of a
chunk of texts. They need that folder mounted; another kind of store is an error.

p(w | u) = max(c(uw) - D, 0) / c(u) + gamma(u) q(w);  q(w) = max(k(w) - E, 0) / K + rho / (V + 1)

where k(w) is the number of different words before w, K their sum, D and E the three discounts of
Chen and Goodman (from the counts of counts of c and of k), and gamma and rho what they leave. A word
that was never learned has k = 0; after an unknown u, p is q.

Defined cases: a null text is an empty one: its only token is the end. Rows of null ids teach nothing
and are not held out; equal rows count each. With nothing learned, q is 1 and every score 0. Other
columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import by_key, chunks, is_fold, not_fold, partitions, raw, runs, shared_folder, small_batches, stored
from strata.llm.words import U64, mix, split

BEGIN, END = U64(0xB5297A4D3F84D5A1), U64(0x68E31DA4A7C159B3)
_PAIR = U64(0xD6E8FEB86659FD93)


def pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(u * _PAIR + w)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token, of the one before it, and the bounds of each text's tokens."""
    words = split(texts)
    hashes = words.hashes(lower=True)
    n = np.diff(words.first) + 1
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(n, out=bounds[1:])
    own = np.full(bounds[-1], END, U64)
    last = np.zeros(bounds[-1], bool)
    last[bounds[1:] - 1] = True
    own[~last] = hashes
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[bounds[:-1]] = BEGIN
    return own, before, bounds


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "__text"):
        own, before, _ = tokens(raw(batch.column("__text")))
        words, n = np.unique(own, return_counts=True)
        yield pa.RecordBatch.from_arrays([_signed(words), pa.array(n, pa.int64())], names=["word", "n"])


def _buckets(u: np.ndarray, pairs: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the first word; of the pair, where many pairs begin with that word."""
    by = np.where(np.isin(u, hot), pairs, mix(u))
    return ((by >> U64(20)) % U64(buckets)).astype(np.int64)


def _write(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays under their final names only when complete: a repeated task replaces equal files."""
    for part, array in arrays.items():
        at = f"{folder}/{name}.{part}.npy"
        draft = f"{at}.{os.getpid()}.{os.urandom(4).hex()}"
        with open(draft, "wb") as file:
            np.save(file, array)
        os.replace(draft, at)


def _discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and from 3 on, from the numbers of things counted 1 to 4 times.

    Where these numbers are too few for the estimate, the discount is one half.
    """
    if min(n) <= 0:
        return np.array([0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    found = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return np.array([0, *(d if 0 <= d <= i + 1 else 0.5 for i, d in enumerate(found))])


class Model:
    """What a worker needs: numbers, and the folder of the arrays, mapped when first used."""

    def __init__(self, folder: str, buckets: int, hot: np.ndarray, total: int, words: int, kinds: int,
                 pair_discounts: np.ndarray, word_discounts: np.ndarray, left: float, texts: int):
        self.folder, self.buckets, self.hot = folder, buckets, hot
        self.total, self.words, self.kinds = total, words, kinds  # N, V, K
        self.pair_discounts, self.word_discounts, self.left = pair_discounts, word_discounts, left
        self.texts = texts
        self.maps: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"maps": {}}

    def _map(self, name: str) -> np.ndarray | None:
        if name not in self.maps:
            path = f"{self.folder}/{name}.npy"
            self.maps[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.maps[name]

    def _find(self, kind: str, shard: np.ndarray, keys: np.ndarray, parts: list[str]) -> list[np.ndarray]:
        """Values of sorted-array entries; 0 for keys that aren't there."""
        out = [np.zeros(len(keys)) for _ in parts]
        order = np.lexsort((keys, shard))
        edges = np.flatnonzero(np.diff(shard[order], prepend=-1)).tolist() + [len(order)]
        for a, z in zip(edges, edges[1:]):
            own = order[a:z]
            name = f"{kind}{shard[own[0]]}"
            held = self._map(f"{name}.hash")
            if held is None or not len(held):
                continue
            at = np.minimum(np.searchsorted(held, keys[own]), len(held) - 1)
            there = held[at] == keys[own]
            for values, part in zip(out, parts):
                values[own[there]] = self._map(f"{name}.{part}")[at[there]]
        return out

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base score and log10 probability of each text."""
        own, before, bounds = tokens(texts)
        words, back = np.unique(np.concatenate([own, before]), return_inverse=True)
        shard = (words % U64(self.buckets)).astype(np.int64)
        count, kinds, once, twice, more = self._find("w", shard, words, ["n", "kinds", "f1", "f2", "f3"])
        w, u = back[: len(own)], back[len(own) :]
        base = np.log10((count + 0.5) / (self.total + 0.5 * (self.words + 1)))
        d, e = self.pair_discounts, self.word_discounts
        low = np.maximum(kinds - e[np.minimum(kinds, 3).astype(int)], 0) / max(self.kinds, 1) + self.left / (self.words + 1)
        starts = count.copy()
        starts[words == BEGIN] = (once + twice + more > 0)[words == BEGIN] * self.texts
        spent = d[1] * once + d[2] * twice + d[3] * more
        rest = np.where(starts > 0, spent / np.maximum(starts, 1), 1.0)
        pairs, one, again = np.unique(pair_hash(before, own), return_index=True, return_inverse=True)
        (c,) = self._find("p", _buckets(before[one], pairs, self.hot, self.buckets), pairs, ["n"])
        seen = np.maximum(c - d[np.minimum(c, 3).astype(int)], 0)[again] / np.maximum(starts[u], 1)
        score = np.log10(seen + rest[u] * low[w])
        add = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  each text has its end token
        return np.diff(bounds), add((count[w] > 0).astype(np.int64)), add(base[w]), add(score)


def train(docs: DataFrame, *, text: str = "text") -> Model:
    """Count all texts of ``docs`` and write the model's arrays."""
    spark = docs.sparkSession
    small_batches(spark)
    buckets = 4 * partitions(spark)
    folder = shared_folder(spark, "ngram-model")
    os.makedirs(folder, exist_ok=True)
    texts = docs.select(F.col(text).alias("__text"))
    words = stored(texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "ngram-words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    end = words.where(F.col("word") == int(END.view(np.int64))).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    # words that begin more than a quarter of a bucket's fair share: at most 4 * buckets
    rows = words.where(F.col("n") * 4 * buckets > sums.n).select("word").collect()
    hot = np.array([r.word for r in rows], np.int64).view(U64)
    hot = np.union1d(hot, [BEGIN])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text"):
            own, before, _ = tokens(raw(batch.column("__text")))
            pairs, one, n = np.unique(pair_hash(before, own), return_index=True, return_counts=True)
            own, before = own[one], before[one]
            bucket = _buckets(before, pairs, hot, buckets)
            order = np.lexsort((before, bucket))
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
            numbers, packed = [], []
            for a, z in zip(edges, edges[1:]):
                at = order[a:z]
                numbers.append(int(bucket[at[0]]))
                packed.append(zstandard.ZstdCompressor(level=1).compress(
                    before[at].tobytes() + own[at].tobytes() + n[at].astype(np.uint32).tobytes()))
            if numbers:
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())],
                                                 names=["bucket", "packed"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, group in runs(batches, "bucket"):
            us, ws, ns = [], [], []
            for blob in group.column("packed").to_pylist():
                data = zstandard.ZstdDecompressor().decompress(blob)
                n = len(data) // 20
                us.append(np.frombuffer(data, U64, n))
                ws.append(np.frombuffer(data, U64, n, 8 * n))
                ns.append(np.frombuffer(data, np.uint32, n, 16 * n).astype(np.int64))
            u, w, n = np.concatenate(us), np.concatenate(ws), np.concatenate(ns)
            us = ws = ns = None
            pairs = pair_hash(u, w)
            order = np.argsort(pairs)
            pairs = pairs[order]
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
            n = np.add.reduceat(n[order], first)
            u, w, pairs = u[order[first]], w[order[first]], pairs[first]
            _write(folder, f"p{bucket}", {"hash": pairs, "n": n.astype(np.uint32 if n.max() < 1 << 32 else np.int64)})
            times = np.minimum(n, 5)
            tally = np.bincount(times, minlength=6)
            yield _stats(0, np.arange(1, 5, dtype=U64), tally[1:5])
            yield _stats(1, *np.unique(w, return_counts=True))
            for k in (1, 2, 3):
                yield _stats(k + 1, *np.unique(u[np.minimum(n, 3) == k], return_counts=True))

    pairs = by_key(texts.mapInArrow(spread, "bucket int, packed binary"), "bucket")
    stats = stored(pairs.mapInArrow(gather, "kind int, word long, n long"), "ngram-statistics")
    per_pair = {r.word: r.n for r in stats.where("kind = 0").groupBy("word").agg(F.sum("n").alias("n")).collect()}

    def of(kind: int):
        return F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(F.lit(0)))

    # the counts of words and what the buckets found, one row per word
    table = (stats.where("kind > 0").unionByName(words.select(F.lit(9).alias("kind"), "word", "n")).groupBy("word")
             .agg(of(9).alias("n"), of(1).alias("kinds"), of(2).alias("f1"), of(3).alias("f2"), of(4).alias("f3")))
    shard = (F.conv(F.hex("word"), 16, 10).cast("decimal(20,0)") % buckets).cast("int")
    table = table.withColumn("shard", shard)

    def lay_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, group in runs(batches, "shard"):
            keys = group.column("word").to_numpy().view(U64)
            order = np.argsort(keys)
            arrays = {x: group.column(x).to_numpy()[order] for x in ("n", "kinds", "f1", "f2", "f3")}
            kinds = arrays["kinds"]
            small = {x: a.astype(np.uint32) if a.max(initial=0) < 1 << 32 else a for x, a in arrays.items()}
            _write(folder, f"w{number}", {"hash": keys[order]} | small)
            tally = np.bincount(np.minimum(kinds, 5), minlength=6)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([int(tally[i])], pa.int64()) for i in range(1, 5)),
                 pa.array([int((kinds >= 3).sum())], pa.int64()), pa.array([int(kinds.sum())], pa.int64())],
                names=["n1", "n2", "n3", "n4", "more", "total"])

    schema = "n1 long, n2 long, n3 long, n4 long, more long, total long"
    k = by_key(table, "shard").mapInArrow(lay_down, schema).agg(
        *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n1", "n2", "n3", "n4", "more", "total")]).first()
    d = _discounts([per_pair.get(i, 0) for i in range(1, 5)])
    e = _discounts([k.n1, k.n2, k.n3, k.n4])
    left = (e[1] * k.n1 + e[2] * k.n2 + e[3] * k.more) / k.total if k.total else 1.0
    return Model(folder, buckets, hot, sums.n, sums.v, k.total, d, e, left, end)


def _stats(kind: int, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Kind 0: pairs by count; 1: words before each word; 2 to 4: followers seen once, twice, more."""
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(words), kind, np.int32)), _signed(words), pa.array(counts, pa.int64())],
        names=["kind", "word", "n"])


_LOADED: dict[str, Model] = {}

ADDED = T.StructType([T.StructField("__n_tokens", T.LongType()), T.StructField("__n_known", T.LongType()),
                      T.StructField("__base_score", T.DoubleType()), T.StructField("__score", T.DoubleType())])


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with tokens, known tokens, unigram and model log10 probability of each text."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)
    schema = T.StructType(docs.schema.fields + ADDED.fields)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        model = _LOADED.get(own.folder)
        if model is None:  # the maps of one model stay open in a worker
            _LOADED.clear()
            model = _LOADED[own.folder] = own
        for batch in chunks(batches, text):
            n, known, base, found = model.score(raw(batch.column(text)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(found, pa.float64())], names=schema.names)

    return docs.mapInArrow(rate, schema)


def scores(docs: DataFrame) -> DataFrame:
    """Contract of ``op7``: learned from the other folds, applied to every document."""
    model = train(docs.where(not_fold("doc_id", 1)))
    own = docs.select("doc_id", is_fold("doc_id", 1).alias("held_out"), "text")
    return score(own, model).select(
        "doc_id", "held_out", F.col("__n_tokens").alias("n_tokens"), F.col("__n_known").alias("n_known"),
        F.lit(int(model.total)).cast("long").alias("train_tokens"), F.col("__base_score").alias("base_score"),
        F.col("__score").alias("score"), F.expr("pow(10D, -__score / __n_tokens)").alias("perplexity"))
