"""Byte-exact dedup by the suffix order of many texts, built column by column.

A window is ``k`` consecutive bytes of one text. Consecutive windows with the same minimiser (the
smallest hash among their runs of ``GRAM`` bytes) travel as one string to the bucket of that
minimiser, so equal windows meet. In a bucket, strings that share their minimiser with no other
string, nor repeat it, hold no repeat. The others are sorted by suffix: each round inserts one more
symbol of every string, from the last to the first, into the Burrows-Wheeler transform of the
collection and updates the common prefixes of neighbouring suffixes. A symbol's new place is the
count of smaller symbols and of its own kind before its old place; its common prefix with the
neighbour is one more than the least common prefix between the two old places. Both columns are
read and rewritten in order each round, as external files would be; as minimisers cut the
collection into pieces of a bounded size, they stay in memory. Neighbouring suffixes with a common
prefix of ``k`` are equal windows; all but the earliest of them are repeats.

A minimiser with more windows than an even bucket is frequent: its windows are dealt by the
smallest hash among longer runs instead, and where that is frequent too, by all their bytes. Each
chunk of texts keeps the earliest of equal strings only; the others are repeats already, so
thousands of copies of a passage send one string a chunk. Buckets come from the bytes of all texts.
A task collects the strings of several chunks by bucket before it packs them, so packs stay worth
compressing where buckets are many. For the last join longer texts are compressed too.

Defined cases: earlier means a smaller id, or the same id and an earlier start; rows of equal ids
keep their own bytes and don't cover each other at the same start, so equal rows are treated
alike. A null text is empty. Nothing goes from a row with a null id, nor does it count as
earlier. Ids are whole numbers (a text id that is none is an error). Other columns pass through; those that
begin with two underscores are left out, as results are named so. Texts longer than a chunk are cut into pieces that
overlap by ``k - 1`` bytes, which hold each window once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import chunks, lengths, partitions, raw, runs, small_batches, stored
from strata.llm.words import U64, mix, seeds

WINDOW = 100
#: Bytes of the runs among which a window's minimiser is taken, and of those that deal out frequent ones.
GRAM = 20
LONGER = 60
#: Windows of a string at most.
RUN = 128
_CHUNK = 2 << 20
#: Bytes of text whose strings one bucket holds on average.
BUCKET_BYTES = 4 << 20
#: Bytes of strings that a task collects before it packs them by bucket.
HELD_BYTES = 64 << 20
#: Bytes from which on a text is compressed by itself for the last join.
LONG_TEXT = 1 << 10
#: Symbols sorted at a time, unless one minimiser has more.
BATCH = 1 << 18
_TABLE = seeds(256, 17)
_BASE = int(seeds(1, 23)[0])
_NONE = np.zeros(0, U64)
#: Windows whose minimisers are found at a time, and the low bits of a hash that hold a place among them.
_BLOCK = 1 << 15
_PLACE = U64((1 << 16) - 1)


def rolled(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from each place on; its high bits depend on all of them."""
    power, size, out, have = _TABLE[data], 1, None, 0
    while True:
        if k & size:
            if out is None:
                out, have = power, size
            else:
                n = len(data) - have - size + 1
                out = out[:n] + power[have : have + n] * U64(pow(_BASE, have, 1 << 64))
                have += size
        if size * 2 > k:
            return out
        n = len(data) - 2 * size + 1
        power = power[:n] + power[size : size + n] * U64(pow(_BASE, size, 1 << 64))
        size *= 2


def minimisers(data: np.ndarray, k: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each ``k`` bytes the least hash among their runs of ``gram`` bytes, and the first place of it.

    Runs are compared by all but the hash's lowest bits, which hold the place in the block.
    """
    n = max(0, len(data) - k + 1)
    least, place = np.empty(n, U64), np.empty(n, np.int64)
    for a in range(0, n, _BLOCK):
        z = min(n, a + _BLOCK)
        hashes = rolled(data[a : z + k - 1], gram)
        values = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=U64)
        have, width = 1, k - gram + 1
        while have < width:
            step = min(have, width - have)
            values = np.minimum(values[:-step], values[step:])
            have += step
        at = (values & _PLACE).astype(np.int64)
        least[a:z], place[a:z] = hashes[at], at + a
    return least, place


class Windows:
    """The windows of some texts: ``data`` joined, ``at`` their first bytes, ``least`` their minimisers, which stand at
    ``place``, and keys to deal them out by."""

    def __init__(self, texts: list[bytes], k: int, frequent: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)):
        self.k, self.gram = k, min(GRAM, k)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        n = np.maximum(sizes - k + 1, 0)
        self.text = np.repeat(np.arange(len(texts)), n)
        self.at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[self.text]
        if not len(self.at):
            self.key = _NONE
            return
        least, place = minimisers(self.data, k, self.gram)
        self.least, self.place = least[self.at], place[self.at]
        self.key = self.least
        if len(frequent[0]):
            hot = np.flatnonzero(np.isin(self.least, frequent[0]))
            if len(hot):
                longer = self.longer()[hot]
                self.key = self.least.copy()
                self.key[hot] = mix(longer + U64(1))
                hot = hot[np.isin(longer, frequent[1])]
                if len(hot):
                    self.key[hot] = mix(rolled(self.data, k)[self.at[hot]] + U64(2))

    def longer(self) -> np.ndarray:
        return minimisers(self.data, self.k, min(LONGER, self.k))[0][self.at]

    def strings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows of one key: number of the first window, first byte, end, and whether the minimiser moves."""
        new = np.ones(len(self.at), bool)
        new[1:] = (self.at[1:] != self.at[:-1] + 1) | (self.text[1:] != self.text[:-1]) | (self.key[1:] != self.key[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(new)))
        if size.max() > RUN:
            nth = np.arange(len(new)) - np.repeat(begin, size)
            begin = np.flatnonzero(nth % RUN == 0)
        last = np.append(begin[1:], len(new)) - 1
        return begin, self.at[begin], self.at[last] + self.k, self.place[begin] != self.place[last]


def _cut(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, keys, first bytes and texts of a chunk; a long text comes in pieces."""
    for batch in chunks(batches, "__text", _CHUNK):
        ids = batch.column("__id").to_numpy(zero_copy_only=False)
        keys = batch.column("__key").to_numpy(zero_copy_only=False)
        texts = raw(batch.column("__text"))
        if len(texts) == 1 and len(texts[0]) > 2 * _CHUNK:
            for a in range(0, len(texts[0]) - k + 1, _CHUNK):
                yield ids, keys, np.array([a]), [texts[0][a : a + _CHUNK + k - 1]]
        else:
            yield ids, keys, np.zeros(len(ids), np.int64), texts


def _frequent(docs: DataFrame, k: int, buckets: int, of: np.ndarray | None = None) -> np.ndarray:
    """Minimisers that have more windows than an even bucket; those of the longer runs in the windows of the minimisers ``of``.

    Strings of a chunk with the same ends, middle and length count once. A chunk counts the minimisers above a
    quarter of the limit.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, texts in _cut(batches, k):
            own = Windows(texts, k)
            if not len(own.at):
                continue
            begin, first, end, _ = own.strings()
            n = np.diff(np.append(begin, len(own.at)))
            hashes = [_gram_at(own.data, x, own.gram) for x in (first, (first + end - own.gram) // 2, end - own.gram)]
            _, one = np.unique(mix(mix(mix(hashes[0]) + hashes[1]) + hashes[2]) + (end - first).astype(U64), return_index=True)
            total = int(n[one].sum())
            if of is None:
                value, row = np.unique(own.least[begin[one]], return_inverse=True)
                sums = np.bincount(row, n[one], len(value)).astype(np.int64)
            else:
                mine = one[np.isin(own.least[begin[one]], of)]
                at = np.repeat(begin[mine], n[mine]) + np.arange(n[mine].sum()) - np.repeat(np.cumsum(n[mine]) - n[mine], n[mine])
                value, sums = np.unique(own.longer()[at] if len(at) else _NONE, return_counts=True)
            often = sums * 4 * buckets > total
            yield pa.RecordBatch.from_arrays([pa.array([None, *value[often].view(np.int64).tolist()], pa.int64()),
                                              pa.array([total, *sums[often].tolist()], pa.int64())], names=["least", "n"])

    counted = stored(docs.mapInArrow(count, "least long, n long").groupBy("least").agg(F.sum("n").alias("n")), "suffix-frequent")
    total = counted.where("least is null").agg(F.sum("n")).collect()[0][0] or 0
    hot = counted.where("least is not null").where(F.col("n") * (4 * buckets) > 3 * total).collect()  # fewer than 4/3 x buckets rows
    return np.array([r.least for r in hot], np.int64).view(U64)


def _gram_at(data: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at some places."""
    out = np.zeros(len(at), U64)
    for i in range(gram):
        out = out * U64(_BASE) + _TABLE[data[at + i]]
    return out


def frequent_minimisers(docs: DataFrame, k: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent minimisers of runs of ``GRAM`` bytes, and among their windows those of ``LONGER`` bytes."""
    one = _frequent(docs, k, buckets)
    return one, _frequent(docs, k, buckets, one) if len(one) else _NONE


#: Id, key, place, what a frequent minimiser is dealt by (0 for another one), length, place of the minimiser, moves.
_FIELDS = (np.int64, np.int64, np.int64, np.uint32, np.uint16, np.uint16, np.uint8)


def _pack(kind: int, columns: list[np.ndarray], bodies: list[bytes]) -> bytes:
    """Columns byte by byte, the first bytes of all rows first: equal bytes stand together."""
    head = [np.array([kind, len(columns[0])], np.int64).tobytes()]
    for c, t in zip(columns, _FIELDS):
        head.append(c.astype(t).view(np.uint8).reshape(len(c), -1).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(head + bodies))


def _unpack(blob: bytes) -> tuple[int, list[np.ndarray], bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    kind, n = np.frombuffer(data, np.int64, 2).tolist()
    columns, at = [], 16
    for t in _FIELDS:
        size = n * np.dtype(t).itemsize
        columns.append(np.frombuffer(data, np.uint8, size, at).reshape(-1, n).T.copy().view(t).ravel())
        at += size
    return kind, columns, data[at:]


def _earliest(strings: list[bytes], ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether each is the earliest of its equals."""
    least: dict[bytes, tuple[int, int]] = {}
    where = list(zip(ids.tolist(), places.tolist()))
    for s, w in zip(strings, where):
        if least.setdefault(s, w) > w:
            least[s] = w
    return np.fromiter((least[s] == w for s, w in zip(strings, where)), bool, len(strings))


def _dealt(ids: np.ndarray, keys: np.ndarray, offsets: np.ndarray, texts: list[bytes], k: int, buckets: int,
           frequent) -> Iterator[tuple[int, int, list[np.ndarray], bytes]]:
    """Strings by bucket: bucket, kind, columns and bytes; kind 1: those that the chunk itself shows to be repeats."""
    own = Windows(texts, k, frequent)
    if not len(own.at):
        return
    begin, first, end, moves = own.strings()
    body = own.data.tobytes()
    strings = [body[a:z] for a, z in zip(first.tolist(), end.tolist())]
    text = own.text[begin]
    named = np.where(own.key[begin] == own.least[begin], U64(0), mix(own.key[begin]) >> U64(32))
    columns = [ids[text], keys[text], first - own.first[text] + offsets[text], named, end - first,
               own.place[begin] - first, moves]
    mine = _earliest(strings, columns[0], columns[2])
    bucket = (mix(own.key[begin]) % U64(buckets)).astype(np.int64)
    gone = np.flatnonzero(~mine)
    if len(gone):
        yield int(bucket[gone[0]]), 1, [c[gone] for c in columns], b""
    order = np.flatnonzero(mine)
    order = order[np.argsort(bucket[order], kind="stable")]
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
    for a, z in zip(edges, edges[1:]):
        rows = order[a:z]
        yield int(bucket[rows[0]]), 0, [c[rows] for c in columns], b"".join([strings[i] for i in rows.tolist()])


def _packs(batches: Iterator[pa.RecordBatch], k: int, buckets: int, frequent) -> Iterator[pa.RecordBatch]:
    """Packed strings by ``bucket``, one pack of ``HELD_BYTES`` of strings for each bucket and kind."""
    held: dict[tuple[int, int], list[tuple[list[np.ndarray], bytes]]] = {}
    size = 0

    def packed() -> pa.RecordBatch:
        names, blobs = [], []
        while held:
            (bucket, kind), parts = held.popitem()
            names.append(bucket)
            blobs.append(_pack(kind, [np.concatenate(c) for c in zip(*(c for c, _ in parts))], [b for _, b in parts]))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "packed"])

    for ids, keys, offsets, texts in _cut(batches, k):
        for bucket, kind, columns, body in _dealt(ids, keys, offsets, texts, k, buckets, frequent):
            held.setdefault((bucket, kind), []).append((columns, body))
            size += len(body) + sum(c.nbytes for c in columns)
        if size >= HELD_BYTES:
            yield packed()
            size = 0
    if held:
        yield packed()


def insert_columns(data: np.ndarray, first: np.ndarray, length: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of the strings ``data[first : first + length]`` and the common prefixes of
    neighbouring suffixes, up to ``cap`` (255 at most): one symbol of each string a round.

    Symbols are bytes plus one (no text in UTF-8 has byte 255); 0 ends a string.
    """
    m = len(first)
    end = first + length
    bwt = np.where(length > 0, data[np.maximum(end - 1, 0)] + 1, 0).astype(np.uint8)
    lcp = np.zeros(m + 1, np.uint8)  # one more for the ranges' ends
    place = np.arange(m)  # of the longest suffix of each string so far
    live = np.flatnonzero(length > 0)
    for t in range(1, int(length.max(initial=0)) + 1):
        if not len(live):
            break
        order = np.argsort(bwt, kind="stable")  # radix sort: symbols, then places
        fresh = np.zeros(len(bwt), bool)
        fresh[place[live]] = True
        rank = np.flatnonzero(fresh[order])
        old = order[rank]
        to = rank - (m - len(live)) + m  # the strings that ended have a 0 before all others
        by = np.argsort(place[live])
        own = live[by][np.searchsorted(place[live][by], old)]
        symbol = bwt[old]
        # neighbours of the same symbol, and the least common prefix between the places
        before, after = order[np.maximum(rank - 1, 0)], order[np.minimum(rank + 1, len(bwt) - 1)]
        has_before, has_after = (rank > 0) & (bwt[before] == symbol), (rank + 1 < len(bwt)) & (bwt[after] == symbol)
        sort = np.argsort(old)
        up = np.zeros(len(old), np.uint8)
        down = np.zeros(len(old), np.uint8)
        for out, has, a, z in ((up, has_before, before, old), (down, has_after, old, after)):
            rows = sort[has[sort]]
            if len(rows):
                spans = np.empty(2 * len(rows), np.int64)
                spans[::2], spans[1::2] = a[rows] + 1, z[rows] + 1
                out[rows] = np.minimum(np.minimum.reduceat(lcp, spans)[::2], cap - 1) + 1
        stay = np.ones(len(bwt) + len(old), bool)
        stay[to] = False
        grown, prefix = np.empty(len(stay), np.uint8), np.zeros(len(stay) + 1, np.uint8)
        grown[stay] = bwt
        prefix[:-1][stay] = lcp[:-1]
        more = length[own] > t
        grown[to] = np.where(more, data[np.maximum(end[own] - t - 1, 0)] + 1, 0)
        next_ = to[has_after] + 1
        prefix[next_] = down[has_after]  # a new neighbour above states its own below
        prefix[to] = up
        place[own] = to
        bwt, lcp, live = grown, prefix, np.sort(own[more])
    return bwt, lcp[:-1]


def equal_windows(data: np.ndarray, first: np.ndarray, length: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, first byte and class of each window of the strings; equal windows have equal classes."""
    bwt, lcp = insert_columns(data, first, length, k)
    order = np.argsort(bwt, kind="stable")
    above = np.empty(len(order), np.int64)  # place of the suffix that is one symbol longer
    above[order] = np.arange(len(order))
    label = np.cumsum(lcp < k)
    at = np.arange(len(first))
    strings, starts, classes = [], [], []
    for t in range(1, int(length.max(initial=0)) + 1):
        live = np.flatnonzero(length >= t)
        at[live] = above[at[live]]
        if t >= k:
            strings.append(live)
            starts.append(length[live] - t)
            classes.append(label[at[live]])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (strings, starts, classes))


def _spans(ids, keys, starts, ends) -> pa.RecordBatch:
    """One row per document: its spans as pairs of int64."""
    order = np.lexsort((starts, keys, ids))
    ids, keys = ids[order], keys[order]
    pairs = np.stack([starts[order], ends[order]], axis=1).astype(np.int64)
    edges = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))).tolist() + [len(ids)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[edges[:-1]], pa.int64()), pa.array(keys[edges[:-1]], pa.int64()),
         pa.array([pairs[a:z].tobytes() for a, z in zip(edges, edges[1:])], pa.binary())], names=["__id", "__key", "__spans"])


def _shared(data: np.ndarray, group: np.ndarray, first: np.ndarray, sizes: np.ndarray, place: np.ndarray, moves: np.ndarray, k: int) -> np.ndarray:
    """Whether a string may share a window with another of its group, or with itself.

    Equal windows hold the minimiser at one place, so at least half of their other bytes stand on one side of it:
    the strings share the minimiser with that many bytes before it, or after it.
    """
    gram = min(GRAM, k)
    half = (k - gram + 1) // 2
    out = moves > 0
    for begin, fits in ((place - half, place >= half), (place, place + gram + half <= sizes)):
        rows = np.flatnonzero(fits)
        name = mix(_gram_at(data, first[rows] + begin[rows], gram + half) + group[rows].astype(U64) * U64(_BASE))
        _, back, n = np.unique(name, return_inverse=True, return_counts=True)
        out[rows[n[back] > 1]] = True
    return out


def _bucket(parts: list[tuple[int, list[np.ndarray], bytes]], k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Ids, keys, starts and ends of the repeats in a bucket."""
    for kind, (ids, keys, places, _, sizes, _, _), _ in parts:
        if kind == 1:
            yield ids, keys, places, places + sizes
    parts = [p for p in parts if p[0] == 0]
    if not parts:
        return
    ids, keys, places, named, sizes, offset, moves = (np.concatenate([p[1][i] for p in parts]) for i in range(len(_FIELDS)))
    body = b"".join([p[2] for p in parts])
    parts = None
    data = np.frombuffer(body, np.uint8)
    sizes, offset = sizes.astype(np.int64), offset.astype(np.int64)
    first = np.cumsum(sizes) - sizes
    least = np.where(named == 0, _gram_at(data, first + offset, min(GRAM, k)), named.astype(U64))
    _, group, n = np.unique(least, return_inverse=True, return_counts=True)
    rows = np.flatnonzero((n[group] > 1) | (moves > 0))
    rows = rows[_shared(data, group[rows], first[rows], sizes[rows], offset[rows], moves[rows], k)]
    rows = rows[np.argsort(group[rows], kind="stable")]
    strings = [body[a : a + z] for a, z in zip(first[rows].tolist(), sizes[rows].tolist())]
    mine = _earliest(strings, ids[rows], places[rows])
    strings, gone = None, rows[~mine]
    yield ids[gone], keys[gone], places[gone], places[gone] + sizes[gone]
    kept = rows[mine]
    kept = kept[_shared(data, group[kept], first[kept], sizes[kept], offset[kept], moves[kept], k)]
    total = np.cumsum(sizes[kept])
    a = 0
    while a < len(kept):
        z = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + BATCH, side="right")))
        while z < len(kept) and least[kept[z]] == least[kept[z - 1]]:
            z += 1
        own = kept[a:z]
        a = z
        string, start, label = equal_windows(data, first[own], sizes[own], k)
        row = own[string]
        place = places[row] + start
        order = np.lexsort((place, ids[row], label))
        row, place, label = row[order], place[order], label[order]
        head = np.flatnonzero(np.append(True, label[1:] != label[:-1]))
        earliest = np.repeat(head, np.diff(np.append(head, len(label))))
        later = (ids[row] > ids[row[earliest]]) | (place > place[earliest])  # same id: later start
        row, place = row[later], place[later]
        order = np.lexsort((place, row))
        row, place = row[order], place[order]
        if len(row):
            new = np.append(True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1))
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(row)) - 1
            yield ids[row[begin]], keys[row[begin]], place[begin], place[last] + k


def repeat_spans(docs: DataFrame, k: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """Spans of repeated bytes by document; ``docs`` has ``__id`` (not null), ``__key`` and ``__text``."""
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("__text")).alias("size")).collect()[0].size or 0
        buckets = max(partitions(docs.sparkSession), -(-size // BUCKET_BYTES))
    frequent = frequent_minimisers(docs, k, buckets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packs(batches, k, buckets, frequent)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in runs(batches, "bucket"):
            found = [x for x in _bucket([_unpack(b) for b in group.column("packed").to_pylist()], k) if len(x[0])]
            if found:
                yield _spans(*(np.concatenate(x) for x in zip(*found)))

    dealt = docs.mapInArrow(deal, "bucket int, packed binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(sort, "__id long, __key long, __spans binary")


def _light(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with each text of at least ``LONG_TEXT`` bytes moved to ``__light``, compressed; ``__size``: its bytes."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches, text):
            whole = batch.column(text)
            size = lengths(whole)
            light = [packer.compress(x) if len(x) >= LONG_TEXT else None for x in raw(whole)]
            short = pc.if_else(pa.array(size < LONG_TEXT), whole, pa.scalar(b"").cast(whole.type))
            columns = [short if name == text else c for name, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(light, pa.binary()), pa.array(size, pa.int64())],
                                             names=[*batch.schema.names, "__light", "__size"])

    return docs.mapInArrow(go, T.StructType(docs.schema.fields + [
        T.StructField("__light", T.BinaryType()), T.StructField("__size", T.LongType())]))


def _whole(short: pa.Array, light: pa.Array) -> pa.Array:
    """The texts that ``_light`` took apart."""
    packer = zstandard.ZstdDecompressor()
    values = [x if y is None else packer.decompress(y) for x, y in zip(short.cast(pa.large_binary()).to_pylist(), light.to_pylist())]
    large = pa.types.is_large_string(short.type) or pa.types.is_large_binary(short.type)
    return pa.array(values, pa.large_binary() if large else pa.binary()).view(short.type)


def dedup(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the remaining bytes, where some went; a cut may
    fall inside a character) and ``kept_sha256``, each named with two underscores before it."""
    docs = docs.drop(*[c for c in docs.columns if c.startswith("__")])
    if not 1 <= k <= 255:
        raise ValueError("windows have 1 to 255 bytes")
    small_batches(docs.sparkSession)
    named = docs.withColumn("__id", F.col(id).cast("long")).withColumn("__hash", F.xxhash64(text))
    # texts of one id are told apart by their hashes, where an id has several
    several = not named.where("__id is not null").groupBy("__id").agg(F.min("__hash").alias("a"), F.max("__hash").alias("z")).where("a != z").isEmpty()
    own = named.withColumn("__key", F.col("__hash") if several else F.lit(0).cast("long")).drop("__hash")
    spans = repeat_spans(own.where("__id is not null").select("__id", "__key", F.col(text).alias("__text")), k)
    spans = stored(spans.groupBy("__id", "__key").agg(F.collect_list("__spans").alias("__spans")), "suffix-spans")
    joined = _light(own, text).join(spans.hint("shuffle_hash"), ["__id", "__key"], "left").select(*docs.columns, "__light", "__size", "__spans")
    at = docs.columns.index(text)
    schema = T.StructType(docs.schema.fields + [
        T.StructField("__n_bytes", T.LongType()), T.StructField("__n_removed", T.LongType()), T.StructField("__n_spans", T.LongType()),
        T.StructField("__kept", T.BinaryType()), T.StructField("__kept_sha256", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__size"):
            out: list[list] = [[], [], [], [], []]
            texts = _whole(batch.column(text), batch.column("__light"))
            for value, parts in zip(raw(texts), batch.column("__spans").to_pylist()):
                kept, n = value, 0
                if parts:
                    hit = np.zeros(len(value) + 1, np.int32)
                    pairs = np.frombuffer(b"".join(parts), np.int64).reshape(-1, 2)
                    np.add.at(hit, pairs[:, 0], 1)
                    np.add.at(hit, pairs[:, 1], -1)
                    stay = np.cumsum(hit)[:-1] == 0
                    n = int((~stay).sum() and np.count_nonzero(np.diff(np.append(True, stay).astype(np.int8)) == -1))
                    kept = np.frombuffer(value, np.uint8)[stay].tobytes()
                row = (len(value), len(value) - len(kept), n, kept if len(kept) < len(value) else None, hashlib.sha256(kept).hexdigest())
                for column, x in zip(out, row):
                    column.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 : -3], *(pa.array(c, t) for c, t in zip(out, kinds))], names=schema.names)

    return joined.mapInArrow(cut, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Contract of ``op12``: what stays of each document."""
    return dedup(docs.select("doc_id", "text")).select(
        "doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"), F.col("__n_spans").alias("n_spans"),
        F.col("__kept_sha256").alias("kept_sha256"))
