"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A text is the vector of (1 + log tf) * idf over the words that two labelled examples hold at least; document
frequencies are counted over all documents. Words that stand in more than ``COMMON`` of the documents are left out.
A word is telling if its frequency among toxic and other examples differs more than chance allows (the
likelihood-ratio statistic passes a Bonferroni bound over all words tried); its weight is ``TELLING`` times as large,
and it is never too common. Labelled examples with equal vectors are one entry of the index, with the number of its
examples and of its toxic ones.

The index holds the entries in blocks of ``BLOCK``; each term has its largest weight per block. A
text's upper bound for a block is the sum over its terms. The block of the largest bound is opened first; then
those whose bound reaches the ``NEAREST``-th example found in it, so the neighbours are exact. Each neighbour votes
with its similarity as a share of the nearest one's, and the votes are shrunk to the base rate. A text without any
term is judged by the examples without any.

At most ``EXAMPLES`` labelled rows are fitted (those with the smallest hash of the id), and at most
``TERMS`` of their words (telling ones first, then the most frequent): both are parameters, and bound what the driver
holds and broadcasts.

Defined cases: a null text is an empty one, scored like any text without terms. Several labels of one
id count as toxic if one is; null labels and ids teach nothing. With nothing to learn from, every
score is 0. Rows of equal ids are scored one by one. Other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunks, is_fold, make_room, not_fold, shielded, small_batches, trim

#: Labelled rows fitted at most.
EXAMPLES = 20_000
#: Words of the examples kept at most.
TERMS = 1 << 19
#: Share of all documents above which a word that tells nothing is left out.
COMMON = 0.03
#: Weight of a telling word.
TELLING = 9.0
NEAREST = 25
BLOCK = 2048
#: Chance that any word at all passes as telling by accident.
ACCIDENT = 0.05
#: Weight of the base rate among the votes.
SHRINK = 1.0
EVIDENCE = 3
#: Texts whose scores a worker remembers.
REMEMBERED = 10_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Words of letters, in lower case."""
    return _WORD.findall((text or "").lower())


def _tail(statistic: float) -> float:
    """Chance of a chi-square (one degree of freedom) above the statistic."""
    return math.erfc(math.sqrt(max(statistic, 0.0) / 2))


class Index:
    """Distinct example vectors in blocks, with the largest weight of each term per block.

    ``weights`` are those of the terms; an example is a key, term numbers, counts and 0 or 1.
    """

    def __init__(self, terms: list[str], weights: np.ndarray, examples: Iterable[tuple[int, np.ndarray, np.ndarray, int]]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.weights = weights
        groups: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}
        for key, ids, counts, toxic in examples:
            order = np.argsort(ids)
            groups.setdefault((ids[order].astype(np.int32).tobytes(), counts[order].astype(np.int32).tobytes()), []).append((key, toxic))
        everyone = [t for g in groups.values() for _, t in g]
        empty = [t for _, t in groups.pop((b"", b""), [])]
        self.base = (sum(everyone) + 0.5) / (len(everyone) + 1) if everyone else 0.0
        self.empty = (sum(empty) + SHRINK * self.base) / (len(empty) + SHRINK) if everyone else 0.0
        vectors = [(np.frombuffer(i, np.int32), self.unit(np.frombuffer(i, np.int32), np.frombuffer(c, np.int32)), g)
                   for (i, c), g in groups.items()]
        del groups
        # entries with the same weightiest term stand together, so blocks differ in their largest weights
        vectors.sort(key=lambda v: (int(v[0][v[1].argmax()]), -float(v[1].max()), min(v[2])))
        self.n = np.array([len(g) for _, _, g in vectors], float)
        self.toxic = np.array([sum(t for _, t in g) for _, _, g in vectors], float)
        self.first = [min(k for k, _ in g) for _, _, g in vectors]
        self.blocks = max(1, -(-len(vectors) // BLOCK))
        term = np.concatenate([v[0] for v in vectors]) if vectors else np.zeros(0, np.int32)
        entry = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(v[0]) for v in vectors])
        weight = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        del vectors
        order = np.argsort(term, kind="stable")  # entries ascend already
        self.entry, self.weight = entry[order], weight[order]
        cell = term[order].astype(np.int64) * self.blocks + self.entry // BLOCK
        del term, entry, weight, order
        self.cut = np.searchsorted(cell, np.arange(len(weights) * self.blocks + 1)).astype(np.int32)
        largest = np.zeros(len(weights) * self.blocks)
        np.maximum.at(largest, cell, self.weight)
        self.largest = np.nextafter(largest.astype(np.float32), np.float32(np.inf)).reshape(-1, self.blocks)
        self.seen: dict[bytes, tuple[float, list[int]]] = {}

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, ascending, and counts of a text's terms."""
        held = Counter(words_of(text))
        ids = np.fromiter(map(self.number.get, held, repeat(-1)), np.int64, len(held))
        counts = np.fromiter(held.values(), np.int64, len(held))
        order = np.argsort(ids)
        order = order[np.searchsorted(ids[order], 0) :]
        return ids[order], counts[order]

    def unit(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The unit TF-IDF vector of term counts."""
        raw = (1 + np.log(counts)) * self.weights[ids]
        return raw / math.sqrt(math.fsum((raw * raw).tolist())) if len(raw) else raw

    def _cosines(self, ids: np.ndarray, vector: np.ndarray, blocks: np.ndarray | None = None) -> np.ndarray:
        """Cosine of every entry, or of those in some blocks with 0 for the others."""
        if blocks is None:
            begin, end = self.cut[ids * self.blocks], self.cut[(ids + 1) * self.blocks]
        else:
            cells = (ids[:, None] * self.blocks + blocks[None, :]).ravel()
            begin, end, vector = self.cut[cells], self.cut[cells + 1], np.repeat(vector, len(blocks))
        size = (end - begin).astype(np.int64)
        at = np.repeat(begin - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        return np.bincount(self.entry[at], self.weight[at] * np.repeat(vector, size), len(self.n))

    def nearest(self, ids: np.ndarray, vector: np.ndarray) -> list[tuple[float, int]]:
        """The entries of the largest cosine that hold ``NEAREST`` examples together, nearest first."""
        bound = vector @ self.largest[ids].astype(np.float64)
        top = int(bound.argmax())
        if bound[top] < 2 * np.median(bound):  # no block stands out: hardly any could be left closed
            return self._first(self._cosines(ids, vector))
        found = self._first(self._cosines(ids, vector, np.array([top])))
        worst = found[-1][0] if sum(self.n[i] for _, i in found) >= NEAREST else 0.0
        more = np.flatnonzero((bound >= worst - 1e-9) & (bound > 0))
        if len(more) * 4 > self.blocks:
            return self._first(self._cosines(ids, vector))
        more = more[more != top]
        if len(more):
            found += self._first(self._cosines(ids, vector, more))
            found = self._enough(sorted(found, key=lambda x: (-x[0], x[1])))
        return found

    def _first(self, cosines: np.ndarray) -> list[tuple[float, int]]:
        rows = np.flatnonzero(cosines > 0)
        if len(rows) > NEAREST:  # an entry holds one example at least
            rows = rows[cosines[rows] >= np.partition(cosines[rows], len(rows) - NEAREST)[len(rows) - NEAREST]]
        rows = rows[np.lexsort((rows, -cosines[rows]))]
        return self._enough(list(zip(cosines[rows].tolist(), rows.tolist())))

    def _enough(self, found: list[tuple[float, int]]) -> list[tuple[float, int]]:
        total = 0.0
        for k, (_, i) in enumerate(found):
            total += self.n[i]
            if total >= NEAREST:
                return found[: k + 1]
        return found

    def score(self, text: str | None) -> tuple[float, list[int]]:
        """The share of toxic votes, and the ids of the nearest examples."""
        key = hashlib.blake2b((text or "").encode(), digest_size=16).digest()
        if key not in self.seen:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            ids, counts = self.counts(text)
            near = self.nearest(ids, self.unit(ids, counts)) if len(ids) else []
            if near:
                share = [(s / near[0][0], i) for s, i in near]
                votes, toxic = (sum(s * x[i] for s, i in share) for x in (self.n, self.toxic))
                self.seen[key] = (float((toxic + SHRINK * self.base) / (votes + SHRINK)), [self.first[i] for _, i in near[:EVIDENCE]])
            else:
                self.seen[key] = (self.base if len(ids) else self.empty, [])
        return self.seen[key]


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic",
        examples: int = EXAMPLES, terms: int = TERMS) -> Index:
    """The index of at most ``examples`` labelled rows, with document frequencies of all ``docs``."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id).alias("__id")).agg(
        F.max(F.col(label).cast("int")).alias("__toxic"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(examples)
    texts = docs.where(F.col(id).isNotNull()).select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    own = texts.join(F.broadcast(chosen), "__id").groupBy("__id", "__toxic").agg(F.min("__text").alias("__text"))
    listed = own.mapInArrow(_term_counts, "id long, toxic int, terms array<string>, counts array<int>")
    listed = listed.persist()
    try:
        frequency = listed.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
            F.count("*").alias("n"), F.sum("toxic").alias("toxic")).persist()
        sizes = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
        tried = frequency.count()
        n, toxic = sizes.n, sizes.toxic

        def part(x, expected):
            return F.when(x > 0, x * F.log(x / expected)).otherwise(F.lit(0.0))

        a, b = F.col("toxic").cast("double"), (F.col("n") - F.col("toxic")).cast("double")
        c, d = toxic - a, (n - toxic) - b
        has, other = F.col("n") / max(n, 1), (n - F.col("n")) / max(n, 1)
        statistic = 2 * (part(a, has * toxic) + part(b, has * (n - toxic)) + part(c, other * toxic) + part(d, other * (n - toxic)))
        limit = next((x / 100 for x in range(0, 20_000) if _tail(x / 100) * max(tried, 1) < ACCIDENT))
        telling = (statistic > limit) if 0 < toxic < n else F.lit(False)
        kept = (frequency.where("n >= 2").select("term", "n", telling.alias("telling"))
                .orderBy(F.desc("telling"), F.desc("n"), "term").limit(terms).toArrow())
        frequency.unpersist()
        names, tells = kept.column("term").to_pylist(), kept.column("telling").to_numpy()
        every, df = _document_counts(docs.select(F.col(text).alias("__text")), names)
        df = np.maximum(df, kept.column("n").to_numpy())
        weights = np.log((1 + max(every, 1)) / (1 + np.minimum(df, every))) * np.where(tells, TELLING, 1.0)
        good = (weights > 0) & (tells | (df <= COMMON * every) | (df <= 2))
        names, weights = [t for t, g in zip(names, good.tolist()) if g], weights[good]
        number = {t: i for i, t in enumerate(names)}

        def rows() -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
            for r in listed.orderBy("id").toLocalIterator():
                pairs = [(number[t], c) for t, c in zip(r.terms, r.counts) if t in number]
                ids, counts = zip(*pairs) if pairs else ((), ())
                yield r.id, np.array(ids, np.int64), np.array(counts, np.int64), r.toxic

        return Index(names, weights, rows())
    finally:
        listed.unpersist()
        trim()


def _document_counts(texts: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each term; a task adds up its own first."""
    spark = texts.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        number = {t: i for i, t in enumerate(held.value)}
        sums, rows = np.zeros(len(number) + 1, np.int64), 0
        for batch in chunks(batches, "__text"):
            rows += batch.num_rows
            own: Counter[str] = Counter()
            for t in batch.column("__text").to_pylist():
                own.update(set(words_of(t)))
            ids = np.fromiter(map(number.get, own, repeat(-1)), np.int64, len(own))
            np.add.at(sums, ids[ids >= 0], np.fromiter(own.values(), np.int64, len(own))[ids >= 0])
        sums[-1] = rows
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["term", "n"])

    found = texts.mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms) + 1, np.int64)
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return int(out[-1]), out[:-1]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "__text"):
        counts = [Counter(words_of(t)) for t in batch.column("__text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("__id").cast(pa.int64()), batch.column("__toxic").cast(pa.int32()),
             pa.array([list(c) for c in counts], pa.list_(pa.string())),
             pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))],
            names=["id", "toxic", "terms", "counts"])


def judge(docs: DataFrame, index: Index, *, text: str = "text") -> DataFrame:
    """``docs`` with ``__score`` and ``__evidence``, the ids of the nearest examples."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(index)
    schema = docs.select("*", F.lit(0.0).alias("__score"), F.lit(None).cast("array<long>").alias("__evidence")).schema

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        index = held.value
        for batch in chunks(batches, text):
            found = [index.score(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([s for s, _ in found], pa.float64()),
                 pa.array([e for _, e in found], pa.list_(pa.int64()))], names=schema.names)

    return docs.mapInArrow(rate, schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of ``op5``: learned from the other folds, applied to every document."""
    small_batches(docs.sparkSession)
    index = fit(docs, labels.where(not_fold("doc_id", 0)))
    own = docs.select("doc_id", is_fold("doc_id", 0).alias("held_out"), "text")
    return judge(own, index).select(
        "doc_id", "held_out", F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"),
        F.col("__evidence").alias("evidence"))


@shielded
def remove_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those scored ``threshold`` or higher."""
    small_batches(docs.sparkSession)
    index = fit(docs, labels.where(not_fold("doc_id", 0)))
    return judge(docs, index).where(F.col("__score") < threshold).select(*docs.columns)
