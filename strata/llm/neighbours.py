"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives an exact neighbour graph. The graph is partitioned in balance:
from a start by k-means, vectors move in rounds to the part that holds most of their neighbours while
it has room. A softmax classifier learns the parts of the sample's vectors; it is the index: every vector of the table
lies in its likeliest part, and a query goes to the parts likeliest to hold its neighbours. Their number
is measured: an eighth of the sample is kept out of the fit, and as many parts are probed as find the share
``RECALL`` of its neighbours by inner product in the rest; and further ones, until those probed surely hold ``k``
candidates. In the probed parts a query's inner products with all vectors are exact, in double precision, on the
original vectors, added up in the order of the components whatever the block, so equal vectors tie.

Parts may be uneven on the whole table, so a part is dealt to blocks of at most about ``BLOCK`` vectors by
a hash, and its queries likewise; a task holds one block of each at a time, whatever a part's
size. Each pair of blocks returns a query's best ``k`` candidates, and these are merged.

The number of parts grows with the square root of the number of vectors up to ``MAX_PARTS``, which
with the dimension bounds the classifier that is broadcast. Vectors are brought to unit length for the
graph and the classifier only.

Defined cases: a vector takes no part if it is null, has a null or non-finite component, or is zero,
or if its id is null, or if its length isn't the table's commonest (the smallest of several). Rows of one
id are candidates and queries of their own: each query row has its own list, which leaves out all rows of its id.
Ties go to the smaller id.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import by_key, runs, small_batches, stored

K = 20
#: Vectors sampled for the graph and the classifier.
SAMPLE = 8_192
#: Neighbours of each vector in the graph.
GRAPH = 10
MAX_PARTS = 256
#: Recall that the number of probed parts is chosen for, on vectors kept out of the fit.
RECALL = 0.95
BLOCK = 4_096
ROUNDS = 15
STEPS = 300


def parts_for(n: int) -> int:
    """Parts for n vectors: about the square root of n / 64, at least 4."""
    return int(min(MAX_PARTS, max(4, 2 ** round(math.log2(max(n, 1) / 64) / 2))))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of each row by inner product, in blocks."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for a in range(0, len(x), 1024):
        near = x[a : a + 1024] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 1024] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, : out.shape[1]] if out.shape[1] else out[a : a + 1024]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """The part of each row: neighbours together, no part beyond a tenth more than its share."""
    centres = x[rng.choice(len(x), parts, replace=False)]
    room = math.ceil(1.1 * len(x) / parts)
    for _ in range(10):
        part = _seat(x @ centres.T, room)
        centres = np.stack([x[part == p].mean(axis=0) if (part == p).any() else centres[p] for p in range(parts)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    for _ in range(ROUNDS):
        votes = np.zeros((len(x), parts), np.float32)
        rows = np.repeat(np.arange(len(x)), near.shape[1])
        np.add.at(votes, (rows, part[near].ravel()), 1)
        np.add.at(votes, (near.ravel(), part[rows]), 1)
        new = _seat(votes + 0.5 * np.eye(parts, dtype=np.float32)[part], room)
        if (new == part).all():
            break
        part = new
    return part


def _seat(liking: np.ndarray, room: int) -> np.ndarray:
    """Give each row the part it likes best that still has room, the most decided rows first."""
    n, parts = liking.shape
    part = np.full(n, -1)
    left = np.full(parts, room)
    liking = liking.astype(np.float64)
    waiting = np.arange(n)
    while len(waiting):
        own = liking[waiting]
        best = own.argmax(axis=1)
        keen = own[np.arange(len(own)), best]
        order = np.lexsort((waiting, -keen, best))
        place = np.arange(len(order)) - np.searchsorted(best[order], best[order])
        fits = place < left[best[order]]
        seated = waiting[order[fits]]
        part[seated] = best[order[fits]]
        left -= np.bincount(part[seated], minlength=parts)
        waiting = np.sort(waiting[order[~fits]])
        liking[:, left <= 0] = -np.inf
    return part


def learn(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights (dimension + 1 by parts) of a softmax classifier of the target shares, by Adam on all rows."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, m, v = np.zeros((x.shape[1], target.shape[1])), 0.0, 0.0
    for t in range(1, STEPS + 1):
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (z / z.sum(axis=1, keepdims=True) - target) / len(x) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def fit(vectors: np.ndarray, parts: int, k: int) -> tuple[np.ndarray, int]:
    """The classifier, and how many parts to probe."""
    rng = np.random.default_rng(0)
    order = rng.permutation(len(vectors))
    apart, base = order[: len(vectors) // 8], order[len(vectors) // 8 :]
    x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    own = x[base]
    parts = min(parts, len(own))
    near = neighbour_graph(own, GRAPH)
    part = np.eye(parts)[balanced_parts(own, near, parts, rng)]
    # a row's own part and those of its neighbours: queries are routed to where neighbours lie
    w = learn(own, (part + part[near].mean(axis=1)) / 2 if near.shape[1] else part)
    if not len(apart) or len(base) <= k:
        return w, parts
    lies = route(own, w, 1)[:, 0]
    true = np.argpartition(-(vectors[apart] @ vectors[base].T), k - 1, axis=1)[:, :k]
    rank = np.argsort(route(x[apart], w, parts), axis=1)  # of each part, for each query
    found = np.sort(rank[np.arange(len(apart))[:, None], lies[true]].ravel())
    share = min(1.0, RECALL + 0.5 / math.sqrt(len(apart)))  # the fewer were kept out, the less the measure is trusted
    return w, int(found[math.ceil(share * len(found)) - 1]) + 1


def route(x: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """The n likeliest parts of each row, likeliest first."""
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    z = unit @ w[:-1] + w[-1]
    return np.argsort(-z, axis=1, kind="stable")[:, :n]


def probed(order: np.ndarray, sizes: np.ndarray, probes: int, k: int) -> np.ndarray:
    """How many parts of each row's ``order`` to probe: ``probes``, or as many as hold ``k`` ids besides one's own."""
    held = np.cumsum(np.maximum(sizes[order] - 1, 0), axis=1)
    return np.maximum(min(probes, order.shape[1]), np.minimum((held < k).sum(axis=1) + 1, order.shape[1]))


def _matrix(column) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``id`` and ``vec`` (doubles, as bytes) of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
                      & F.exists(v, lambda c: c != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0].n if sizes else 0)).mapInArrow(_as_bytes, "id long, vec binary")


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "vec"])


def search(vectors: DataFrame, is_query, *, id: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """The ``k`` nearest of each vector for which ``is_query`` (a condition on ``id``) holds:
    ``query_id``, ``rank``, ``vec_id``, ``score``."""
    spark = vectors.sparkSession
    small_batches(spark)
    table = stored(usable(vectors, id, vector).withColumn("row", F.monotonically_increasing_id()), "neighbours-vectors")
    count = table.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = parts_for(count)
    sample = table.orderBy(F.xxhash64("id", "vec"), "id").limit(SAMPLE).select("vec").distinct().orderBy("vec").toArrow()
    weights, probes = fit(_matrix(sample.column("vec")), parts, k)
    parts = weights.shape[1]
    held = spark.sparkContext.broadcast(weights)

    def place(sizes: np.ndarray | None):
        """Rows with their part, or (given the parts' sizes) once for every part to probe."""

        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                to = route(_matrix(batch.column("vec")), held.value, 1 if sizes is None else parts)
                n = np.ones(len(to), np.int64) if sizes is None else probed(to, sizes, probes, k)
                rows = pa.array(np.repeat(np.arange(len(to)), n))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(rows) for c in ("id", "row", "vec")), pa.array(to[np.arange(to.shape[1]) < n[:, None]], pa.int64())],
                    names=["id", "row", "vec", "part"])
        return go

    kind, columns = "id long, row long, vec binary, part long", ["id", "row", "vec"]
    indexed = stored(table.select(*columns).mapInArrow(place(None), kind), "neighbours-index")
    # at most MAX_PARTS rows each
    counted = indexed.groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).collect()
    sizes = np.zeros(parts, np.int64)
    sizes[[r.part for r in counted]] = [r.ids for r in counted]
    asked = stored(table.where(is_query(F.col("id"))).select(*columns).mapInArrow(place(sizes), kind), "neighbours-queries")
    blocks = {r.part: -(-r.n // BLOCK) for r in counted}
    groups = {r.part: -(-r.n // BLOCK) for r in asked.groupBy("part").agg(F.count("*").alias("n")).collect()}
    sizes = F.broadcast(spark.createDataFrame(
        [(p, blocks.get(p, 0), groups.get(p, 0)) for p in {*blocks, *groups}], "part long, blocks long, groups long"))

    def dealt(own: DataFrame, mine: str, other: str, side: int) -> DataFrame:
        """Each row in its block, once for every block of the other side."""
        rows = own.join(sizes, "part").where("blocks > 0 and groups > 0")
        rows = rows.withColumn("own", F.pmod(F.xxhash64("id", "vec"), F.col(mine))).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        block, group = ("own", "other") if side == 0 else ("other", "own")
        return rows.select(F.xxhash64("part", block, group).alias("cell"), F.lit(side).alias("side"), "id", "row", "vec")

    cells = dealt(indexed, "blocks", "groups", 0).unionByName(dealt(asked, "groups", "blocks", 1))
    best = by_key(cells, "cell", "side").mapInArrow(_best(k), "query_id long, row long, ids array<long>, scores array<double>")
    merged = best.groupBy("query_id", "row").agg(F.collect_list("ids").alias("ids"), F.collect_list("scores").alias("scores"))
    return merged.mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices, one by one, added up component by component."""
    out = np.zeros(len(x))
    for i in range(x.shape[1]):
        out += x[:, i] * y[:, i]
    return out


def _best(k: int):
    """Of each query row and block: the k candidates of the largest inner product."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cell in runs(batches, "cell"):
            side = cell.column("side").to_numpy()
            ids, row = cell.column("id").to_numpy(), cell.column("row").to_numpy()
            x = _matrix(cell.column("vec"))
            mine = np.flatnonzero(side == 0)
            if not len(mine):
                continue
            c_ids, c = ids[mine], x[mine]
            longest = np.linalg.norm(c, axis=1).max()
            asked = np.flatnonzero(side == 1)
            for a in range(0, len(asked), 256):
                own = asked[a : a + 256]
                near = x[own] @ c.T
                near[ids[own][:, None] == c_ids[None, :]] = -np.inf
                # what rounding may have put below the cut comes too
                slack = 1e-12 * x.shape[1] * longest * np.linalg.norm(x[own], axis=1)
                found, values = [], []
                for i, q in enumerate(own.tolist()):
                    cut = np.partition(near[i], len(mine) - k)[len(mine) - k] - slack[i] if len(mine) > k else -np.inf
                    at = np.flatnonzero((near[i] >= cut) & (near[i] > -np.inf))
                    score = _products(np.broadcast_to(x[q], (len(at), x.shape[1])), c[at])
                    order = np.lexsort((c_ids[at], -score))[:k]
                    found.append(c_ids[at[order]])
                    values.append(score[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[own]), pa.array(row[own]), pa.array(found, pa.list_(pa.int64())),
                     pa.array(values, pa.list_(pa.float64()))], names=["query_id", "row", "ids", "scores"])

    return go


def _merge(k: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for q, ids, scores in zip(*(batch.column(x).to_pylist() for x in ("query_id", "ids", "scores"))):
                i, s = np.concatenate([np.array(x, np.int64) for x in ids]), np.concatenate([np.array(x) for x in scores])
                for rank, at in enumerate(np.lexsort((i, -s))[:k].tolist(), 1):
                    out.append((q, rank, int(i[at]), float(s[at])))
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.float64())], names=["query_id", "rank", "vec_id", "score"])

    return go


def nearest(vectors: DataFrame) -> DataFrame:
    """Contract of ``op6``: every vector whose id is divisible by 20, against all others."""
    return search(vectors, lambda id: id % 20 == 0)
