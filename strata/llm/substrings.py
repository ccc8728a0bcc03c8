"""Substring dedup by super-k-mers of words.

A window is ``k`` consecutive words. Its minimiser is the smallest hash among its runs of ``M``
words; consecutive windows of a document that share it travel as one string of words, a
super-k-mer, to the bucket of that minimiser. Equal windows have equal minimisers and meet in one
bucket. There the strings are cut into windows again, sorted, and compared word by word with the
window of the smallest document among their equals; a window that also starts in a smaller document
is a repeat. The words that repeats cover go.

A minimiser of more windows than an even bucket is frequent. Its windows are dealt by the smallest hash among their
runs of ``LONGER`` words instead, and where that is frequent too, by the hash of all their words: each depends on the
window's words alone, so equal windows still meet. Frequent ones are counted first, over the distinct windows of
each chunk; a chunk counts those above a quarter of the limit, so at most a quarter of a minimiser's share is missed.

Before the shuffle each chunk of documents keeps, of equal super-k-mers, only those of its smallest
document; the others are repeats already. So a passage that a third of all documents share sends one
string per chunk to its bucket, and a bucket's strings come packed and compressed.

Defined cases: words are the runs of bytes other than ASCII white space; a null or wordless text
has none. Nothing goes from a document with a null id, nor does it count as smaller or larger.
Rows of equal ids are one document when judging what is smaller, and each row keeps its own words;
equal rows are treated alike. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import by_key, chunks, partitions, raw, runs, shielded, small_batches, stored
from strata.llm.words import U64, canonical, mix, seeds, split

WINDOW = 13
#: Words of the runs among which a window's minimiser is taken.
M = 2
#: Words of the runs that deal out the windows of a frequent minimiser.
LONGER = 5
_C = seeds(64, 3)
_COMPARE = 1 << 20
#: Text bytes of a chunk whose super-k-mers are packed together.
_CHUNK = 4 << 20


def minimisers(hashes: np.ndarray, k: int, m: int = M) -> np.ndarray:
    """The minimiser among runs of ``m`` words of the window that starts at each word, whatever texts it spans."""
    n = len(hashes) - m + 1
    grams = np.zeros(n, U64)
    for i in range(m):
        grams += hashes[i : i + n] * _C[i]
    grams = mix(grams)
    width, have = k - m + 1, 1
    least = grams
    while have < width:  # minima over 1, 2, 4, ... grams, and at last over all of a window's
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def _windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the window that starts at each word, whatever texts it spans."""
    out = np.zeros(len(hashes) - k + 1, U64)
    for i in range(k):
        out += hashes[i : i + len(out)] * _C[16 + i]
    return out


def _whole(words, k: int) -> np.ndarray:
    """First words of the windows that lie in one text."""
    whole = np.zeros(max(0, len(words.starts) - k + 1), bool)
    for a, z in zip(words.first.tolist(), words.first[1:].tolist()):
        whole[a : max(a, z - k + 1)] = True
    return np.flatnonzero(whole)


def _keys(hashes: np.ndarray, k: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What deals out the window that starts at each word: a function of the window's words."""
    out = minimisers(hashes, k)
    if len(frequent[0]):
        hot = np.flatnonzero(np.isin(out, frequent[0]))
        longer = minimisers(hashes, k, min(LONGER, k))[hot]
        out[hot] = mix(longer + U64(1))
        if len(frequent[1]):
            hot = hot[np.isin(longer, frequent[1])]
            out[hot] = mix(_windows(hashes, k)[hot] + U64(2))
    return out


def frequent_minimisers(docs: DataFrame, k: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers of runs of ``M`` and of ``LONGER`` words that have more windows than an even bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text", _CHUNK):
            words = split(raw(batch.column("__text")))
            at = _whole(words, k)
            if not len(at):
                continue
            hashes = words.hashes()
            at = at[np.unique(_windows(hashes, k)[at], return_index=True)[1]]
            found = [(np.zeros(1, np.int32), np.zeros(1, U64), np.array([len(at)]))]
            for level, m in ((1, M), (2, min(LONGER, k))):
                least, n = np.unique(minimisers(hashes, k, m)[at], return_counts=True)
                often = n * 4 * buckets > len(at)
                found.append((np.full(often.sum(), level, np.int32), least[often], n[often]))
            level, least, n = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(level), pa.array(least.view(np.int64)), pa.array(n, pa.int64())],
                                             names=["level", "least", "n"])

    counted = stored(docs.where("__id is not null").select("__text").mapInArrow(count, "level int, least long, n long")
                     .groupBy("level", "least").agg(F.sum("n").alias("n")), "substring-frequent")
    total = counted.where("level = 0").agg(F.sum("n")).collect()[0][0] or 0
    # fewer than 2 x 4/3 x buckets rows
    hot = counted.where("level > 0").where(F.col("n") * (4 * buckets) > 3 * total).collect()
    one, two = ([r.least for r in hot if r.level == level] for level in (1, 2))
    return np.array(one, np.int64).view(U64), np.array(two, np.int64).view(U64)


def _pack(kind: int, ids: np.ndarray, keys: np.ndarray, places: np.ndarray, body: bytes) -> bytes:
    n = np.array([kind, len(ids)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(
        b"".join([n, ids.tobytes(), keys.tobytes(), places.astype(np.int32).tobytes(), body]))


def _unpack(blob: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    kind, n = np.frombuffer(data, np.int64, 2).tolist()
    ids = np.frombuffer(data, np.int64, n, 16)
    keys = np.frombuffer(data, np.int64, n, 16 + 8 * n)
    places = np.frombuffer(data, np.int32, n, 16 + 16 * n)
    return kind, ids, keys, places, data[16 + 20 * n :]


def _super_k_mers(batch: pa.RecordBatch, k: int, buckets: int,
                  frequent: tuple[np.ndarray, np.ndarray] = (np.zeros(0, U64),) * 2) -> Iterator[tuple[int, bytes]]:
    """Packed super-k-mers by bucket, and what the chunk itself shows to be repeats."""
    ids = batch.column("__id").to_numpy(zero_copy_only=False)
    keys = batch.column("__key").to_numpy(zero_copy_only=False)
    words = split(raw(batch.column("__text")))
    at = _whole(words, k)
    if not len(at):
        return
    least = _keys(words.hashes(), k, frequent)[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    first, end = at[begin], at[last] + k  # words
    text, start = canonical(words)
    strings = [text[a:z] for a, z in zip(start[first].tolist(), (start[end] - 1).tolist())]
    doc = np.searchsorted(words.first, first, side="right") - 1
    owner = ids[doc]
    smallest: dict[bytes, int] = {}
    for s, d in zip(strings, owner.tolist()):
        if smallest.setdefault(s, d) > d:
            smallest[s] = d
    mine = np.fromiter((smallest[s] for s in strings), np.int64, len(strings)) == owner
    place = first - words.first[doc]
    bucket = (mix(least[begin]) % U64(buckets)).astype(np.int64)
    gone = ~mine
    if gone.any():
        sizes = (end - first)[gone]
        yield int(bucket[0]), _pack(1, owner[gone], keys[doc][gone], place[gone], sizes.astype(np.int32).tobytes())
    order = np.flatnonzero(mine)
    order = order[np.argsort(bucket[order], kind="stable")]
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
    for a, z in zip(edges, edges[1:]):
        own = order[a:z]
        yield int(bucket[own[0]]), _pack(0, owner[own], keys[doc[own]], place[own], b"\n".join([strings[i] for i in own.tolist()]))


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``a`` and from ``b`` on are the same, over each size."""
    out = np.ones(len(a), bool)
    total = np.cumsum(size)
    at = 0
    while at < len(a):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + _COMPARE, side="right")))
        n = size[at:end]
        row = np.repeat(np.arange(end - at), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        differ = data[a[at:end][row] + step] != data[b[at:end][row] + step]
        out[at + row[differ]] = False
        at = end
    return out


def _repeats(ids: np.ndarray, strings: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all windows of the strings (each of the document in ``ids``): string and first word of the repeats."""
    words = split(strings.split(b"\n"))
    n = np.diff(words.first) - k + 1  # windows of each string
    owner = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = words.first[:-1][owner] + nth
    window = _windows(words.hashes(), k)[at]
    doc = ids[owner]
    order = np.lexsort((doc, window))
    window, doc = window[order], doc[order]
    new = np.append(True, window[1:] != window[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]  # of the equal ones, that of the smallest document
    maybe = np.flatnonzero(doc > doc[first])
    a, b = at[order[maybe]], at[order[first[maybe]]]
    size = words.ends[a + k - 1] - words.starts[a]
    same = size == words.ends[b + k - 1] - words.starts[b]
    same[same] = _same(words.data, words.starts[a[same]], words.starts[b[same]], size[same])
    if not same.all():  # other windows of the same hash: settled by their bytes
        text = words.data.tobytes()
        clash = np.isin(window, window[maybe[~same]])
        spelled = [text[words.starts[x] : words.ends[x + k - 1]] for x in at[order[clash]].tolist()]
        smallest: dict[bytes, int] = {}
        for s, d in zip(spelled, doc[clash].tolist()):
            smallest[s] = min(d, smallest.get(s, d))
        real = np.flatnonzero(clash)[[smallest[s] < d for s, d in zip(spelled, doc[clash].tolist())]]
        maybe = np.union1d(maybe[same & ~clash[maybe]], real)
    else:
        maybe = maybe[same]
    found = np.sort(order[maybe])
    return owner[found], nth[found]


_SPANS = "__id long, __key long, __spans binary"


def _by_document(ids, keys, starts, ends) -> pa.RecordBatch:
    """One row per document: its spans as int32 pairs."""
    order = np.lexsort((starts, keys, ids))
    ids, keys = ids[order], keys[order]
    pairs = np.stack([starts[order], ends[order]], axis=1).astype(np.int32)
    edges = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))).tolist() + [len(ids)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[edges[:-1]], pa.int64()), pa.array(keys[edges[:-1]], pa.int64()),
         pa.array([pairs[a:z].tobytes() for a, z in zip(edges, edges[1:])], pa.binary())],
        names=["__id", "__key", "__spans"])


def dealt(docs: DataFrame, k: int, buckets: int) -> DataFrame:
    """Packed super-k-mers of ``docs`` by ``bucket``."""
    frequent = frequent_minimisers(docs, k, buckets)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text", _CHUNK):
            if out := list(_super_k_mers(batch, k, buckets, frequent)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())],
                    names=["bucket", "packed"])

    return docs.where("__id is not null").select("__id", "__key", "__text").mapInArrow(spread, "bucket int, packed binary")


def repeat_spans(docs: DataFrame, k: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """Spans of repeated words by document; ``docs`` has ``__id``, ``__key`` and ``__text``."""
    buckets = buckets or 4 * partitions(docs.sparkSession)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in runs(batches, "bucket"):
            parts = [_unpack(x) for x in group.column("packed").to_pylist()]
            found = []
            for kind, ids, keys, places, body in parts:
                if kind == 1:
                    found.append((ids, keys, places, places + np.frombuffer(body, np.int32)))
            held = [p for p in parts if p[0] == 0]
            if held:
                ids, keys, places = (np.concatenate([p[i] for p in held]) for i in (1, 2, 3))
                bodies = b"\n".join([p[4] for p in held])
                parts = held = None  # only the joined copy stays in memory
                string, nth = _repeats(ids, bodies, k)
                if len(string):
                    new = np.append(True, (string[1:] != string[:-1]) | (nth[1:] != nth[:-1] + 1))
                    a = np.flatnonzero(new)
                    z = np.append(a[1:], len(string)) - 1
                    own = string[a]
                    found.append((ids[own], keys[own], places[own] + nth[a], places[own] + nth[z] + k))
            if found:
                yield _by_document(*(np.concatenate(x) for x in zip(*found)))

    return by_key(dealt(docs, k, buckets), "bucket").mapInArrow(sort, _SPANS)


def dedup(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_removed`` and ``__kept``: the kept words, joined by one space
    where some went (else null, and the text stands as it is), and ``__sha256`` of the kept words so joined."""
    small_batches(docs.sparkSession)
    own = docs.withColumn("__id", F.col(id).cast("long")).withColumn("__key", F.xxhash64(text)).withColumn("__text", F.col(text))
    spans = repeat_spans(own, k).groupBy("__id", "__key").agg(F.collect_list("__spans").alias("__spans"))
    joined = own.drop("__text").join(spans.hint("shuffle_hash"), ["__id", "__key"], "left").select(*docs.columns, "__spans")
    schema = T.StructType(docs.schema.fields + [
        T.StructField("__n_words", T.LongType()), T.StructField("__n_removed", T.LongType()),
        T.StructField("__kept", T.StringType()), T.StructField("__sha256", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            n_words, n_removed, kept, digest = [], [], [], []
            for value, parts in zip(raw(batch.column(text)), batch.column("__spans").to_pylist()):
                words = value.split()
                n, gone = len(words), 0
                if parts:
                    hit = np.zeros(n + 1, np.int32)
                    pairs = np.frombuffer(b"".join(parts), np.int32).reshape(-1, 2)
                    np.add.at(hit, pairs[:, 0], 1)
                    np.add.at(hit, pairs[:, 1], -1)
                    keep = np.cumsum(hit)[:n] == 0
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                    gone = n - len(words)
                left = b" ".join(words)
                n_words.append(n)
                n_removed.append(gone)
                kept.append(left.decode() if gone else None)
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(digest, pa.string())], names=schema.names)

    return joined.mapInArrow(cut, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Contract of ``op1``: what stays of each document."""
    return dedup(docs.select("doc_id", "text")).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"),
        F.col("__sha256").alias("kept_sha256"))


@shielded
def remove_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: str | None = "n_chars",
                   k: int = WINDOW) -> DataFrame:
    """``docs`` with the kept words as text where some went; ``size`` names a column with the text's length."""
    out = dedup(docs, id=id, text=text, k=k)
    changed = F.col("__kept").isNotNull()
    if size in docs.columns:
        out = out.withColumn(size, F.when(changed, F.length("__kept")).otherwise(F.col(size)).cast(docs.schema[size].dataType))
    return out.withColumn(text, F.coalesce("__kept", text)).select(*docs.columns)
