"""N-gram Jaccard join by chosen paths: which documents share most of their five-word shingles.

Documents with equal shingle sets are collapsed first: one representative carries their number.
Each representative has a sketch of ``SKETCH`` minhashes. A chosen-path run starts with all
representatives in one bucket; at each level every member of a bucket that is still larger than
``SMALL`` goes to the buckets of the sketch tokens that the level samples (the same for all: a token
is taken if its hash under the path falls below ``TOKENS / SKETCH``). Two sets of similarity s share
a sampled token of a level with chance about 1 - exp(-TOKENS * s), 0.7 at the threshold. ``RUNS``
independent runs miss a pair at the threshold with a chance of about 1 in 100,000 where its buckets
are small after one level, and 1 in 1,000 where they stay large through all; pairs of one
candidate group count however they were found, so the latter are mostly found by others.

Small buckets are compared pair by pair on the sketch (only links that may reach the threshold go
on). A bucket that is still large at the last level shares several tokens; its members are linked
to its smallest. The components of these links are candidate groups. Every group is then
verified exactly: its members' shingle sets are compared, all pairs, tile by tile; a tile
returns for each member how many documents it is linked to, and a spanning forest of the links. So
no pair of a group is written, no task holds more than two tiles of a group, and every link between
two texts of a group counts once, however its members met. The components of the verified links are
the classes.

Defined cases: words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. A text
of one to four words has the one shingle of all its words. A null or wordless text is a class of its
own without links, and so is a row of null id (its class is null). Each row is a document, also where
several have one id: each is compared by its own text. A class is named by its smallest id, so two classes share a name
where an id has texts in both; ``keep_one`` tells them apart. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import by_key, chunks, raw, runs, shielded, small_batches, stored
from strata.llm.components import components
from strata.llm.words import OTHER, U64, mix, seeds, split

SHINGLE = 5
THRESHOLD = 0.8
SKETCH = 128
#: Sketch tokens that a level takes, on average.
TOKENS = 1.5
RUNS = 10
LEVELS = 3
#: A bucket of so many members is compared pair by pair.
SMALL = 64
#: Sketch agreement below which a pair can't reach the threshold (4.5 deviations).
AGREE = THRESHOLD - 4.5 * (THRESHOLD * (1 - THRESHOLD) / SKETCH) ** 0.5
#: Members of a group in one tile of the verification.
TILE = 512
_C = seeds(SHINGLE, 11)
_HASHES = seeds(SKETCH, 23)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, one text after the other and sorted, and the bounds of each text's."""
    words = split(texts, OTHER)
    hashes = words.hashes(lower=True)
    n_words = np.diff(words.first)
    n = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    text = np.repeat(np.arange(len(n)), n)
    at = words.first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    sums = np.zeros(len(at), U64)
    padded = np.append(hashes, np.zeros(SHINGLE, U64))
    inside = np.minimum(n_words, SHINGLE)[text]
    for i in range(SHINGLE):
        sums += np.where(i < inside, padded[at + i] * _C[i], U64(0))
    sums = mix(sums)
    order = np.lexsort((sums, text))
    sums, text = sums[order], text[order]
    kept = np.append(True, (sums[1:] != sums[:-1]) | (text[1:] != text[:-1])) if len(sums) else np.zeros(0, bool)
    sums, text = sums[kept], text[kept]
    return sums, np.searchsorted(text, np.arange(len(texts) + 1))


def sketches(sums: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``SKETCH`` minhashes (32 bits each) of each non-empty set, in order."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.zeros((len(starts), SKETCH), np.uint32)
    step = 1 << 16
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
        stop = starts[end] if end < len(starts) else len(sums)
        own = sums[starts[at] : stop]
        for j in range(SKETCH):
            least = np.minimum.reduceat((own ^ (own >> U64(29))) * _HASHES[j], starts[at:end] - starts[at])
            out[at:end, j] = (mix(least) >> U64(32)).astype(np.uint32)
        at = end
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identity of each shingle set (two 64-bit sums over its hashes, and its size) and its sketch."""
    for batch in chunks(batches, "__text"):
        sums, bounds = shingles(raw(batch.column("__text")))
        size = np.diff(bounds).astype(np.int32)
        has = np.flatnonzero(size)
        one, two = np.zeros(len(size), U64), np.zeros(len(size), U64)
        sketch: list[bytes | None] = [None] * len(size)
        if len(has):
            one[has] = np.add.reduceat(mix(sums + U64(1)), bounds[has])
            two[has] = np.bitwise_xor.reduceat(mix(sums ^ _HASHES[0]), bounds[has])
            for i, row in zip(has.tolist(), sketches(sums, bounds)):
                sketch[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("__id"), batch.column("__hash"), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(size),
             pa.array(sketch, pa.binary())], names=["id", "hash", "one", "two", "size", "sketch"])


def _chosen(level: int):
    """Rows of the next level: the buckets of the tokens that a level takes from each member's sketch."""
    limit = np.uint64(int(TOKENS / SKETCH * 2.0**64))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(SKETCH, dtype=U64) * _HASHES[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH).astype(U64)
            # runs at the first level; afterwards the path of the bucket
            paths = [np.full(len(ids), r + 1, U64) for r in range(RUNS)] if level == 0 else [
                batch.column("path").to_numpy().view(U64)]
            for path in paths:
                token = mix(mix(path)[:, None] ^ mix(place + sketch))
                row, _ = np.nonzero(token < limit)
                new = mix(token[token < limit] + U64(level)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(new), pa.array(ids[row])], names=["path", "id"])

    return go


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of small buckets: pairs whose sketches agree enough, as a spanning forest of the bucket."""
    a_all, b_all = [], []
    for _, group in runs(batches, "path"):
        ids = group.column("id").to_numpy()
        if len(ids) < 2:
            continue
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH)
        same = (sketch[:, None, :] == sketch[None, :, :]).sum(axis=2) >= AGREE * SKETCH
        for a, b in _forest(same):
            a_all.append(ids[a])
            b_all.append(ids[b])
        if len(a_all) >= 10_000:
            yield _edges(a_all, b_all)
            a_all, b_all = [], []
    if a_all:
        yield _edges(a_all, b_all)


def _edges(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric 0/1 matrix."""
    n = len(linked)
    free = np.ones(n, bool)
    out: list[tuple[int, int]] = []
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            new = np.flatnonzero(linked[at] & free)
            free[new] = False
            out += [(at, int(x)) for x in new]
            queue += new.tolist()
    return out


def candidate_links(reps: DataFrame) -> DataFrame:
    """Edges between representatives (``node``, ``sketch``) that may be similar."""
    links = []
    reps = reps.select(F.col("node").alias("id"), "sketch")
    rows = reps
    for level in range(LEVELS):
        paths = stored(rows.mapInArrow(_chosen(level), "path long, id long"), "jaccard-paths", few=level > 0)
        # small buckets with the same members, found in several runs, count once; every path of a large one goes on,
        # as a path may take no token
        buckets = (paths.groupBy("path").agg(F.count("*").alias("n"), F.min("id").alias("least"),
                                             F.sum((F.xxhash64("id") / 4096).cast("long")).alias("members"))
                   .where("n > 1").groupBy("n", "least", "members", F.when(F.col("n") > SMALL, F.col("path")).alias("own"))
                   .agg(F.min("path").alias("path")))
        buckets = stored(buckets, "jaccard-buckets", few=True)
        small = paths.join(buckets.where(F.col("n") <= SMALL).select("path"), "path").join(reps.select("id", "sketch"), "id")
        links.append(by_key(small.select("path", "id", "sketch"), "path", "id").mapInArrow(_near, "a long, b long"))
        large = buckets.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        members = paths.join(large.select("path", "least"), "path")
        if level + 1 == LEVELS:
            links.append(members.select(F.col("id").alias("a"), F.col("least").alias("b")))
        else:
            rows = members.select("path", "id").join(reps.select("id", "sketch"), "id")
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "__text"):
        sums, bounds = shingles(raw(batch.column("__text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("group"), batch.column("id"), batch.column("copies"), batch.column("tile"), batch.column("tiles"),
             pa.array([sums[a:z].tobytes() for a, z in zip(bounds, bounds[1:])], pa.binary())],
            names=["group", "id", "copies", "tile", "tiles", "set"])


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``."""
    out = np.zeros((len(a), len(b)), np.float32)
    shared = np.intersect1d(np.concatenate(a), np.concatenate(b)) if a is not b else None
    if shared is None:
        values, times = np.unique(np.concatenate(a), return_counts=True)
        shared = values[times > 1]
    for at in range(0, len(shared), 4096):  # 0/1 matrices over a block of the shared shingles
        block = shared[at : at + 4096]
        rows = [_marks(x, block) for x in ((a,) if a is b else (a, b))]
        out += rows[0] @ rows[-1].T
    return out


def _marks(sets: list[np.ndarray], block: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(block)), np.float32)
    for i, s in enumerate(sets):
        own = s[np.searchsorted(s, block[0]) : np.searchsorted(s, block[-1], side="right")]
        place = np.minimum(np.searchsorted(block, own), len(block) - 1)
        out[i, place[block[place] == own]] = 1
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of tiles: linked documents of each member, and a spanning forest of the links."""
    nodes, counts, others = [], [], []
    for _, group in runs(batches, "pair"):
        side = group.column("side").to_numpy()
        ids = group.column("id").to_numpy()
        copies = group.column("copies").to_numpy().astype(np.int64)
        sets = [np.frombuffer(x, U64) for x in group.column("set").to_pylist()]
        if (side == 2).all():  # one tile with itself
            left = right = np.arange(len(ids))
            a = b = sets
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            a, b = [sets[i] for i in left], [sets[i] for i in right]
        if not len(left) or not len(right):
            continue
        both = _overlaps(a, b).astype(np.float64)
        size = np.array([len(s) for s in sets], float)
        linked = both >= THRESHOLD * (size[left][:, None] + size[right][None, :] - both) - 1e-9
        if a is b:
            np.fill_diagonal(linked, False)
            matrix = linked
        else:
            n = len(ids)
            matrix = np.zeros((n, n), bool)
            matrix[np.ix_(left, right)] = linked
            matrix[np.ix_(right, left)] = linked.T
        degree = matrix @ copies
        for i in np.flatnonzero(degree).tolist():
            nodes.append(ids[i])
            counts.append(int(degree[i]))
            others.append(None)
        for x, y in _forest(matrix):
            nodes.append(ids[x])
            counts.append(0)
            others.append(ids[y])
        if len(nodes) >= 10_000:
            yield _found(nodes, counts, others)
            nodes, counts, others = [], [], []
    if nodes:
        yield _found(nodes, counts, others)


def _found(nodes: list, counts: list, others: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(others, pa.int64())],
                                      names=["id", "linked", "other"])


def verified(docs: DataFrame, reps: DataFrame, links: DataFrame) -> DataFrame:
    """Verified links of the candidate groups: ``id``, ``linked`` documents, and forest edges to ``other``.

    ``docs`` has ``__id``, ``__hash`` and ``__text``; a representative names one of its documents by id and hash.
    """
    groups = components(links).withColumnRenamed("root", "group")
    groups = groups.join(reps.select("node", "copies", F.col("id").alias("__id"), F.col("hash").alias("__hash")), "node")
    groups = stored(groups.withColumnRenamed("node", "id"), "jaccard-groups", few=True)
    # members are dealt to tiles by a hash, so no group is counted through in one task
    sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = groups.join(sizes, "group").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    member = ["group", "id", "copies", "tile", "tiles"]
    # shuffled at every size: the members grow with the corpus
    texts = docs.join(tiled.hint("shuffle_hash"), ["__id", "__hash"]).groupBy(*member).agg(F.min("__text").alias("__text"))
    sets = texts.mapInArrow(_sets, "group long, id long, copies long, tile int, tiles int, set binary")
    # each pair of tiles once: side 2 is a tile with itself, sides 0 and 1 two tiles
    with_all = sets.withColumn("with", F.explode(F.expr("sequence(0, tiles - 1)")))
    low, high = F.least("tile", "with"), F.greatest("tile", "with")
    pairs = with_all.select(
        F.xxhash64("group", low, high).alias("pair"), "id", "copies", "set",
        F.when(F.col("tile") == F.col("with"), 2).when(F.col("tile") == low, 0).otherwise(1).alias("side"))
    return by_key(pairs, "pair").mapInArrow(_verify, "id long, linked long, other long")


def classes(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document of ``docs``: ``__id`` and ``__hash`` (of its text), ``__class`` (the smallest id of its class,
    null for a null id), ``__links``, the number of other documents linked to it, and ``__first``: whether it is
    the document of the smallest id and hash in its class."""
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col(id).cast("long").alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    key = ["one", "two", "size"]
    described = stored(own.where("__id is not null").mapInArrow(
        _describe, "id long, hash long, one long, two long, size int, sketch binary"), "jaccard-sets")
    reps = described.where("size > 0").groupBy(key).agg(
        F.min(F.struct("id", "hash")).alias("least"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
    # sets are nodes, named by their place in the stored table
    reps = stored(reps.select(F.monotonically_increasing_id().alias("node"), *key, "least.id", "least.hash", "copies", "sketch"),
                  "jaccard-representatives", few=True)
    found = stored(verified(own, reps, candidate_links(reps)), "jaccard-links")
    roots = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy(F.col("id").alias("node")).agg(F.sum("linked").alias("linked"))
    table = (reps.select("node", *key, "copies", "id", "hash").join(roots, "node", "left").join(linked, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    first = table.groupBy("root").agg(F.min(F.struct("id", "hash")).alias("first"))
    table = table.join(first, "root").select(*key, "first", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("__links"))
    alone = F.col("first").isNull()
    sets = described.select("id", "hash", *key).join(table, key, "left").select(
        F.col("id").alias("__id"), F.col("hash").alias("__hash"), F.coalesce("first.id", "id").alias("__class"),
        F.coalesce("__links", F.lit(0)).cast("long").alias("__links"),
        (alone | ((F.col("first.id") == F.col("id")) & (F.col("first.hash") == F.col("hash")))).alias("__first"))
    nameless = own.where("__id is null").select("__id", "__hash", F.col("__id").alias("__class"), F.lit(0).cast("long").alias("__links"),
                                                F.lit(True).alias("__first"))
    return sets.unionByName(nameless)


def join(docs: DataFrame) -> DataFrame:
    """``op8``: every document with its class and its number of links."""
    return classes(docs).select(F.col("__id").alias("doc_id"), F.col("__class").alias("class_id"), F.col("__links").alias("n_links"))


@shielded
def keep_one(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id; rows without an id stay.

    Of rows with one id and one text the one whose columns have the smallest hash stays. An empty table gives none.
    """
    found = classes(docs, id=id, text=text).where("__id is not null").groupBy("__id", "__hash").agg(
        F.max("__first").alias("__keep"), (F.count("*") > 1).alias("__again"))
    own = docs.withColumns({"__id": F.col(id).cast("long"), "__hash": F.xxhash64(text)})
    own = own.join(found.hint("shuffle_hash"), ["__id", "__hash"], "left").where(F.coalesce("__keep", F.lit(True)))
    again = F.coalesce("__again", F.lit(False))
    hashable = [F.col(f.name) for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = Window.partitionBy("__id", "__hash").orderBy(F.xxhash64(*hashable))
    repeated = own.where(again).withColumn("__nth", F.row_number().over(order)).where("__nth = 1")
    return own.where(~again).select(*docs.columns).unionByName(repeated.select(*docs.columns))
