"""Phrases of two and three words that stand together more often than their parts do.

Suffix pointers of words are sorted by multikey three-way quicksort to a depth of three words. A
suffix is a word and the two after it in its piece of text. Each chunk of documents adds up its
equal suffixes first; then they are routed by their two leading words, so all suffixes that begin
with a phrase of two or three words meet in one bucket. There a partition of pointers is split by
its pivot's word into smaller, equal and larger ones, all partitions of a round at once; an equal
partition goes on to the next word, and its size is the count of the phrase read so far. A
partition below the least count is abandoned, whatever phrases it holds.

Leading words that hold more suffixes than an even bucket are frequent; their suffixes are routed
by all three words, and the counts of the two leading words are added up over the buckets. They
are found first, with the words: a chunk counts the pairs above a quarter of the limit, so at
most a quarter of a pair's share is missed. Buckets come from the bytes of all texts.

Words travel as 64-bit hashes of language and word. Should two words share one, the hashes are
drawn anew. Counts of the frequent words and phrases are then joined, scored and ranked by Spark;
products are decimals of 38 digits, exact for counts below 10^14.

Defined cases: a null text is empty, a null language is ``und``; documents without an id count
like all others, repeated rows count again; other columns are ignored; an empty table gives no
row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import chunks, partitions, raw, runs, small_batches, stored
from strata.llm.words import LOWER, U64, Words, mix, seeds, split

#: Words of a suffix.
DEPTH = 3
LEAST = 10
#: Percent of a phrase's count that a longer candidate needs to replace it.
SHARE = 50
TOP = 2000
#: Parts of a language's phrases that are ranked apart first.
SALTS = 32
_CHUNK = 4 << 20
#: Bytes of text whose suffixes one bucket holds on average, and buckets of a task, which takes them one by one.
BUCKET_BYTES = 3 << 20
BUCKETS = 4
PIECE = np.zeros(256, bool)
PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = PIECE.copy()
BETWEEN[[0x20, 0x09]] = True
_C = seeds(8, 11)
#: Bytes compared at a time.
_COMPARE = 1 << 20


def _ids(words: Words, langs: list[str], draw: int) -> np.ndarray:
    """A 64-bit name of each word within its language, never 0."""
    salt = {x: U64(int.from_bytes(np.random.default_rng([draw, *x.encode()]).bytes(8), "little")) for x in set(langs)}
    salts = np.array([salt[x] for x in langs], U64)
    ends = words.data[words.starts].astype(U64) * _C[3] + words.data[words.ends - 1] * _C[4] + (words.ends - words.starts).astype(U64) * _C[5]
    out = mix(words.hashes(lower=True) + salts[words.text] + (ends * U64(draw)))
    out[out == 0] = U64(1)
    return out


def _suffixes(words: Words, ids: np.ndarray) -> list[np.ndarray]:
    """The three words of each suffix that has two at least; 0 beyond the end of its piece."""
    piece = np.cumsum(PIECE[words.data], dtype=np.int64)[words.starts]
    at = np.flatnonzero(piece[1:] == piece[:-1]) if len(piece) else np.zeros(0, np.int64)
    third = np.minimum(at + 2, len(ids) - 1)
    inside = (at + 2 < len(ids)) & (piece[third] == piece[at]) if len(at) else np.zeros(0, bool)
    return [ids[at], ids[at + 1], np.where(inside, ids[third], U64(0))]


def _added(keys: list[np.ndarray], by: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of ``keys`` in the order of ``by``, their counts, and ``by``. Rows of equal ``by`` that
    differ are kept apart."""
    order = np.argsort(by)
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.diff(np.append(first, len(order))), by[order[first]]


def _differ(lower: np.ndarray, words: Words, lang: np.ndarray, twin: np.ndarray) -> np.ndarray:
    """Numbers of the words that are not the same as their ``twin``, in spelling or language."""
    size = words.ends - words.starts
    out = (size != size[twin]) | (lang != lang[twin])
    total, at = np.cumsum(size), 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _COMPARE, side="right")))
        row = np.repeat(np.arange(at, end), np.where(out[at:end], 0, size[at:end]))
        step = np.arange(len(row)) - np.repeat(*_run_starts(row))
        out[row[lower[words.starts[row] + step] != lower[words.starts[twin[row]] + step]]] = True
        at = end
    return np.flatnonzero(out)


def _run_starts(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal numbers begins, and its length."""
    begin = np.flatnonzero(np.diff(row, prepend=-1))
    return begin, np.diff(np.append(begin, len(row)))


def _chunk(batch: pa.RecordBatch) -> tuple[Words, list[str]]:
    return split(raw(batch.column("text")), BETWEEN), batch.column("lang").to_pylist()


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _C[0] + b * _C[1])


def _words(docs: DataFrame, buckets: int, draw: int) -> DataFrame:
    """``lang``, ``word``, ``id``, ``n`` of all words; all else null: ``n`` words of ``lang``; ``id`` and ``next`` set,
    ``word`` null: a frequent pair; only ``n`` set: all pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", _CHUNK):
            words, langs = _chunk(batch)
            if not len(words.starts):
                continue
            ids = _ids(words, langs, draw)
            distinct, at, back, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
            lower, text = LOWER[words.data], words.text
            number = {x: i for i, x in enumerate(sorted(set(langs)))}
            other = _differ(lower, words, np.array([number[x] for x in langs])[text], at[back])
            # a word that shares its hash with another is named beside it, which shows the clash
            distinct, at, n = np.append(distinct, ids[other]), np.append(at, other), np.append(n, 0 * other)
            body, text = lower.tobytes(), text[at]
            spelled = [body[a:z].decode() for a, z in zip(words.starts[at].tolist(), words.ends[at].tolist())]
            total: dict[str, int] = {}
            for lang, k in zip(langs, np.diff(words.first).tolist()):
                total[lang] = total.get(lang, 0) + k
            one, two, _ = _suffixes(words, ids)
            pairs, often, _ = _added([one, two], _pair(one, two))
            hot = often * 4 * buckets > len(one)
            columns = {
                "lang": [langs[t] for t in text.tolist()] + list(total) + [None] * (hot.sum() + 1),
                "word": spelled + [None] * (len(total) + hot.sum() + 1),
                "id": distinct.view(np.int64).tolist() + [None] * len(total) + pairs[0][hot].view(np.int64).tolist() + [None],
                "next": [None] * (len(distinct) + len(total)) + pairs[1][hot].view(np.int64).tolist() + [None],
                "n": n.tolist() + list(total.values()) + often[hot].tolist() + [len(one)],
            }
            yield pa.RecordBatch.from_pydict(columns, schema=pa.schema(
                [("lang", pa.string()), ("word", pa.string()), ("id", pa.int64()), ("next", pa.int64()), ("n", pa.int64())]))

    counted = docs.mapInArrow(count, "lang string, word string, id long, next long, n long")
    return counted.groupBy("lang", "word", "id", "next").agg(F.sum("n").alias("n"))


def equal_partitions(keys: list[np.ndarray], weight: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to rows of ``keys`` (0: the row has ended).

    For each depth from 2 on: pointers to one row of each distinct prefix of that many words, and
    its weight, where that is ``least`` or more.
    """
    table = np.stack(keys)
    at = np.arange(len(weight))
    size, depth = np.array([len(at)] if len(at) else [], np.int64), np.zeros(min(1, len(at)), np.int64)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in keys]
    while len(size):
        begin = np.cumsum(size) - size
        three = [table[depth, at[begin + x]] for x in (0 * size, size // 2, size - 1)]
        low, high = np.minimum(three[0], three[1]), np.maximum(three[0], three[1])
        pivot = np.maximum(low, np.minimum(high, three[2]))  # the middle one
        part = np.repeat(np.arange(len(size)), size)
        key, turn = table[depth[part], at], pivot[part]
        side = (key >= turn).astype(np.int8) + (key > turn)
        del key, turn
        # smaller, equal and larger pointers of each partition, in place of it
        n = np.bincount(part * 3 + side, minlength=3 * len(size))
        start = np.cumsum(n) - n
        to = np.empty(len(at), np.int64)
        for s in range(3):
            own = side == s
            nth = np.cumsum(own) - 1
            mine = np.flatnonzero(own)
            group = part[mine] * 3 + s
            before = np.concatenate([[0], np.cumsum(n[s::3])])[part[mine]]
            to[mine] = start[group] + nth[mine] - before
        new = np.empty_like(at)
        new[to] = at
        full = n > 0
        total = np.add.reduceat(weight[new], start[full])
        size, level = n[full], np.repeat(depth, 3)[full]
        equal = (np.flatnonzero(full) % 3) == 1
        ended = equal & (np.repeat(pivot, 3)[full] == 0)
        level = level + equal
        first = new[start[full]]
        often = total >= least
        for d in range(2, len(keys) + 1):
            mine = equal & often & ~ended & (level == d)
            found[d - 1].append((first[mine], total[mine]))
        go = often & ~ended & (level < len(keys))
        at, size, depth = new[np.repeat(go, size)], size[go], level[go]
    return [tuple(map(np.concatenate, zip(*x))) if x else (np.zeros(0, np.int64), np.zeros(0, np.int64)) for x in found[1:]]


def _pack(kind: int, keys: list[np.ndarray], n: np.ndarray) -> bytes:
    body = b"".join([np.array([kind, len(n)], np.int64).tobytes(), *(k.tobytes() for k in keys), n.astype(np.uint32).tobytes()])
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    kind, n = np.frombuffer(data, np.int64, 2).tolist()
    return kind, np.frombuffer(data, U64, DEPTH * n, 16).reshape(DEPTH, n), np.frombuffer(data, np.uint32, n, 16 + 8 * DEPTH * n)


def _counted(docs: DataFrame, buckets: int, frequent: np.ndarray, draw: int, least: int) -> DataFrame:
    """``a``, ``b``, ``c`` (null for two words) and ``n`` of each phrase of two or three words that occurs ``least`` times."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", _CHUNK):
            words, langs = _chunk(batch)
            suffixes = _suffixes(words, _ids(words, langs, draw))
            if not len(suffixes[0]):
                continue
            keys, n, _ = _added(suffixes, mix(suffixes[0] * _C[0] + suffixes[1] * _C[1] + suffixes[2] * _C[2]))
            by = _pair(keys[0], keys[1])
            hot = np.isin(by, frequent)
            by[hot] = mix(by[hot] + keys[2][hot] * _C[2])
            bucket = ((by >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64) * 2 + hot
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
            rows = [order[a:z] for a, z in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[r[0]]) // 2 for r in rows], pa.int32()),
                 pa.array([_pack(int(bucket[r[0]]) % 2, [k[r] for k in keys], n[r]) for r in rows], pa.binary())],
                names=["bucket", "packed"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in runs(batches, "bucket"):
            parts = [_unpack(x) for x in group.column("packed").to_pylist()]
            group = None
            for kind in (0, 1):
                own = [p for p in parts if p[0] == kind]
                if not own:
                    continue
                keys = list(np.concatenate([p[1] for p in own], axis=1))
                n = np.concatenate([p[2] for p in own]).astype(np.int64)
                pairs, triples = equal_partitions(keys, n, least)
                found = [([k[triples[0]] for k in keys], triples[1])]
                if kind == 0:
                    found.append(([keys[0][pairs[0]], keys[1][pairs[0]], None], pairs[1]))
                else:  # parts of the frequent pairs' counts, however small
                    order = np.lexsort((keys[1], keys[0]))
                    a, b = keys[0][order], keys[1][order]
                    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                    found.append(([a[first], b[first], None], np.add.reduceat(n[order], first)))
                for (a, b, c), total in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                         pa.nulls(len(a), pa.int64()) if c is None else pa.array(c.view(np.int64)), pa.array(total, pa.int64())],
                        names=["a", "b", "c", "n"])

    routed = docs.mapInArrow(route, "bucket int, packed binary").repartition(-(-buckets // BUCKETS), "bucket").sortWithinPartitions("bucket")
    return routed.mapInArrow(sort, "a long, b long, c long, n long").groupBy("a", "b", "c").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _score(a: str | Column, left: str, right: str) -> Column:
    """Floor of 10^6 a^2 / (left * right)."""
    x, y, z = (F.col(c).cast("decimal(14,0)") for c in (a, left, right))
    top = (x * x).cast("decimal(28,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, (y * z).cast("decimal(28,0)"))


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, share: int = SHARE,
                 top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the two parts of its lowest-scoring cut, ``n`` the words
    of the language. A phrase inside a longer candidate with ``share`` percent of its count or more is left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text")).alias("size")).collect()[0].size or 0
    buckets = max(BUCKETS * partitions(spark), -(-size // BUCKET_BYTES))
    draw = 0
    while True:
        words = stored(_words(own, buckets, draw), "phrase-words")
        spelled = words.where("word is not null")
        if spelled.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            break
        draw += 1  # two words share a hash
    every = words.where("lang is null and id is null").agg(F.sum("n")).collect()[0][0] or 0
    # pairs of more than 3/4 of an even bucket: fewer than 4/3 x buckets rows
    hot = words.where("next is not null").where(F.col("n") * (4 * buckets) > 3 * every).select("id", "next").collect()
    ends = np.array([(r.id, r.next) for r in hot], np.int64).reshape(-1, 2).view(U64)
    counted = stored(_counted(own, buckets, _pair(ends[:, 0], ends[:, 1]), draw, least), "phrase-counts")

    often = spelled.where(F.col("n") >= least).select("id", "lang", "word", "n")
    word = {x: often.select(F.col("id").alias(x), F.col("word").alias(f"w{x}"), F.col("n").alias(f"f{x}")) for x in "abc"}
    pairs, triples = counted.where("c is null").select("a", "b", "n"), counted.where("c is not null")
    longer = (triples.select("a", "b", "n").unionByName(triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "n"))
              .groupBy("a", "b").agg(F.max("n").alias("longest")))
    two = (pairs.join(longer, ["a", "b"], "left").where(F.coalesce(F.col("longest") * 100 < F.col("n") * share, F.lit(True)))
           .join(word["a"], "a").join(word["b"], "b")
           .select("a", F.concat_ws(" ", "wa", "wb").alias("phrase"), F.col("n").alias("count"), F.col("fa").alias("l"),
                   F.col("fb").alias("r"), _score("n", "fa", "fb").alias("score")))
    three = (triples.join(pairs.select("a", "b", F.col("n").alias("fab")), ["a", "b"])
             .join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("fbc")), ["b", "c"])
             .join(word["a"], "a").join(word["b"], "b").join(word["c"], "c")
             .withColumn("s1", _score("n", "fa", "fbc")).withColumn("s2", _score("n", "fab", "fc")))
    early = F.col("s1") <= F.col("s2")
    three = three.select("a", F.concat_ws(" ", "wa", "wb", "wc").alias("phrase"), F.col("n").alias("count"),
                         F.when(early, F.col("fa")).otherwise(F.col("fab")).alias("l"),
                         F.when(early, F.col("fbc")).otherwise(F.col("fc")).alias("r"), F.least("s1", "s2").alias("score"))
    scored = two.unionByName(three).join(often.select(F.col("id").alias("a"), "lang"), "a")
    # the first of each of SALTS parts, then of a language: so many rows meet in one task at most
    order = [F.desc("score"), F.desc("count"), F.asc("phrase")]
    part = Window.partitionBy("lang", "part").orderBy(*order)
    first = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = words.where("lang is not null and word is null").select("lang", "n")
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("count").alias("a"), "l", "r",
                                             "n", "score")
