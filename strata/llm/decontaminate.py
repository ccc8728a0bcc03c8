"""Benchmark decontamination: matching lengths against a generalised suffix automaton.

The normalised words of all test items go into one suffix automaton, which is broadcast.
Training texts stream through it word by word; the automaton holds the longest suffix read so
far that occurs in an item. Where that suffix reaches ``window`` words, its last ``window``
words are an occurrence of a test window; an item shorter than a window counts when the whole
item has been read. Those words are *hit*.

The items are cut into pieces that overlap by a window less a word, and the pieces dealt by hash over as many
*shards* as keep one to ``shard_words`` words. A task builds a shard's automaton; the driver sees one shard at a
time, as bytes, on its way into a broadcast. A worker holds one automaton: where there are several, it
reads a block of texts, takes the shards one after the other, and unites the hit spans.

Defined cases: a null or wordless text has no words and no hit; null or wordless items take no
part; rows of one item id are one item, and so are its pieces; rows are judged one by one, so repeated
documents and null ids give one row each; extra columns pass through.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import by_key, chunks, kept, lengths, runs, small_batches, stored
from strata.llm.words import PLAIN_TABLE

WINDOW = 13
#: Words of test items in one automaton, at most: measured with random words, about 1,140 bytes each while it is
#: built, 1,050 once loaded and 58 as bytes, so some 230 MB, 210 MB and 12 MB.
SHARD_WORDS = 200_000
#: A shard is dealt this many pieces or more, so that shards come out alike.
PIECES = 64
#: Bytes of an automaton in one row on its way out of its task.
PART_BYTES = 8 << 20
#: Bytes of text that wait in a worker while the shards go by.
BLOCK_BYTES = 48 << 20
_PIECES = re.compile(rb"\S+")


def item_words(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and non-ASCII characters."""
    return (text or "").encode().translate(PLAIN_TABLE).split()


class Automaton:
    """Generalised suffix automaton over word numbers.

    ``step[v]`` maps a word number to the next state; ``link[v]`` is the suffix link and
    ``length[v]`` the longest string of the state.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = [name for name, _ in items]
        ends: dict[int, set[int]] = defaultdict(set)  # state of each prefix -> items
        whole: dict[int, set[int]] = defaultdict(set)  # state of each short item
        self.short = 0  # the longest of the short items
        for i, (_, words) in enumerate(items):
            last = 0
            for w in words:
                last = self._extend(last, self.words.setdefault(w, len(self.words)))
                ends[last].add(i)
            if words and len(words) < window:
                whole[last].add(i)
                self.short = max(self.short, len(words))
        self._gather(ends, whole, [len(words) for _, words in items])

    def _extend(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:  # an earlier item has this prefix
            old = step[last][w]
            return old if length[old] == length[last] + 1 else self._split(last, w, old)
        new = self._state({}, length[last] + 1)
        at = last
        while at >= 0 and w not in step[at]:
            step[at][w] = new
            at = link[at]
        if at < 0:
            link[new] = 0
        else:
            old = step[at][w]
            link[new] = old if length[old] == length[at] + 1 else self._split(at, w, old)
        return new

    def _split(self, at: int, w: int, old: int) -> int:
        """Give the strings of ``old`` up to one word past state ``at`` a state of their own."""
        copy = self._state(dict(self.step[old]), self.length[at] + 1)
        self.link[copy], self.link[old] = self.link[old], copy
        while at >= 0 and self.step[at].get(w) == old:
            self.step[at][w] = copy
            at = self.link[at]
        return copy

    def _state(self, step: dict[int, int], length: int) -> int:
        self.step.append(step)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _gather(self, ends: dict[int, set[int]], whole: dict[int, set[int]], sizes: list[int]) -> None:
        """For each state: the state of its strings of ``window`` words, and the short items it ends in.

        ``window_items`` has the items of each window state: those whose prefixes end at or
        below it in the link tree.
        """
        n, k = len(self.length), self.window
        order = sorted(range(n), key=self.length.__getitem__)
        self.at_window = [-1] * n
        self.short_at: list[list[tuple[int, int]]] = [[]] * n  # (words, item), of the state and its suffixes
        self.window_items: dict[int, set[int]] = defaultdict(set)
        for v in order:
            if self.length[v] >= k:
                up = self.link[v]
                self.at_window[v] = v if self.length[up] < k else self.at_window[up]
            own = [(sizes[i], i) for i in whole.get(v, ())]
            above = self.short_at[self.link[v]] if v else []
            self.short_at[v] = above + own if own else above
        for v, items in ends.items():
            if self.at_window[v] >= 0:
                self.window_items[self.at_window[v]] |= items

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged [start, end) spans of hit words, and the items that have occurring windows."""
        step, link, length, k = self.step, self.link, self.length, self.window
        at_window, short_at = self.at_window, self.short_at
        spans: list[tuple[int, int]] = []
        windows: set[int] = set()
        items: set[int] = set()
        root, v, n = step[0], 0, 0
        for i, w in enumerate(map(self.words.get, words)):
            if w is None:
                v = n = 0
                continue
            if w in step[v]:
                v = step[v][w]
                n += 1
            else:
                while v and w not in step[v]:
                    v = link[v]
                n = length[v] + 1 if v else 1
                v = step[v][w] if v else root[w]
            hit = 0
            if n >= k:
                hit = k
                windows.add(at_window[v])
            if short_at[v]:
                for size, item in short_at[v]:
                    if size <= n:
                        items.add(item)
                        hit = max(hit, size)
            if hit:
                start = i + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        for state in windows:
            items |= self.window_items[state]
        return spans, items


def _pieces(benchmark: DataFrame, item: str, text: str, piece_words: int, window: int) -> DataFrame:
    """The items' words, cut so that each window lies in one piece: item, words, their number."""
    step = piece_words - window + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "t"):
            for name, value in zip(batch.column("i").to_pylist(), batch.column("t").to_pylist()):
                words = item_words(value)
                own = [words[at : at + piece_words] for at in range(0, max(1, len(words) - window + 1), step)] if words else []
                for at in range(0, len(own), 1000):
                    some = own[at : at + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some), pa.string()), pa.array([b" ".join(w) for w in some], pa.binary()),
                         pa.array([len(w) for w in some], pa.int64())], names=["item", "words", "n"])

    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t"))
    return rows.mapInArrow(cut, "item string, words binary, n long").dropDuplicates(["item", "words"])


def _build(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for shard, rows in runs(batches, "shard"):
        held = zip(rows.column("item").to_pylist(), rows.column("words").to_pylist())
        data = pickle.dumps(Automaton([(name, words.split()) for name, words in held], window), protocol=5)
        for part, at in enumerate(range(0, len(data), PART_BYTES)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([part], pa.int32()), pa.array([data[at : at + PART_BYTES]], pa.binary())],
                names=["shard", "part", "data"])


def _shards(benchmark: DataFrame, item: str, text: str, shard_words: int, window: int) -> Iterator[bytes]:
    """The pickled automata over all items, one after the other; an empty one if there is no word."""
    pieces = stored(_pieces(benchmark, item, text, max(window, shard_words // PIECES), window), "benchmark-pieces")
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        yield pickle.dumps(Automaton([], window), protocol=5)
        return
    n = 1 if total <= shard_words else -(-2 * total // shard_words)
    dealt = by_key(pieces.select(F.pmod(F.xxhash64("item", "words"), F.lit(n)).alias("shard"), "item", "words"), "shard")
    built = stored(dealt.mapInArrow(lambda batches: _build(batches, window), "shard long, part int, data binary"), "benchmark-automata")
    held, now = bytearray(), None
    for row in built.orderBy("shard", "part").toLocalIterator():
        if held and row.shard != now:
            yield bytes(held)
            held = bytearray()
        held += row.data
        now = row.shard
    yield bytes(held)


#: Columns that ``hit_spans`` adds.
ADDED = T.StructType([
    T.StructField("__n_words", T.LongType()),
    T.StructField("__spans", T.ArrayType(T.IntegerType())),
    T.StructField("__items", T.ArrayType(T.StringType())),
])


def hit_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
              item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with the words of each text, its hit spans (flat starts and ends) and the items hit."""
    spark = docs.sparkSession
    small_batches(spark)
    shards = [spark.sparkContext.broadcast(data) for data in _shards(benchmark, item, item_text, shard_words, window)]
    name = uuid.uuid4().hex
    schema = T.StructType(docs.schema.fields + ADDED.fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(chunks(batches, text), text, BLOCK_BYTES if len(shards) > 1 else 0):
            n_words = [[] for _ in block]
            spans: list[list[list[int]]] = [[[]] * batch.num_rows for batch in block]
            items: list[list[list]] = [[[]] * batch.num_rows for batch in block]
            for number, held in enumerate(shards):
                automaton = kept((name, number), lambda: _loaded(held))
                for b, batch in enumerate(block):
                    n_words[b] = []
                    for row, value in enumerate(batch.column(text).to_pylist()):
                        words = item_words(value)
                        n_words[b].append(len(words))
                        found, hit = automaton.hits(words)
                        if found:
                            flat = [x for span in found for x in span]
                            spans[b][row] = united(spans[b][row], flat) if spans[b][row] else flat
                            items[b][row] = list(dict.fromkeys([*items[b][row], *[automaton.names[i] for i in hit]]))
            for b, batch in enumerate(block):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(n_words[b], pa.int64()), pa.array(spans[b], pa.list_(pa.int32())),
                     pa.array(items[b], pa.list_(pa.string()))], names=schema.names)

    return docs.mapInArrow(scan, schema)


def _loaded(held) -> Automaton:
    automaton = pickle.loads(held.value)
    vars(held).pop("_value", None)  # else the bytes would stay in the worker beside the automaton
    return automaton


def _blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of at least ``limit`` bytes of text, but for the last."""
    block: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        block.append(batch)
        size += int(lengths(batch.column(text)).sum())
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def united(a: list[int], b: list[int]) -> list[int]:
    """The union of two lists of spans."""
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _n_hit():
    spans = F.col("__spans")
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract of ``op3``: one row per document with its hit words and the items found. Rows of one item_id are one item."""
    found = hit_spans(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        _n_hit().alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("__items")).cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", size: str | None = "n_chars",
                        share: float = 0.05, min_hit: int = 1) -> DataFrame:
    """``docs`` without the hit spans, and without documents hit beyond ``share`` of their words.

    A document of which at least ``min_hit`` words and ``share`` of all words are hit goes; from
    one that is hit less, the hit words go with the separators after them. Others stay as they
    are. ``size`` names a column that holds the length of the text and follows it.
    """
    found = hit_spans(docs, benchmark, text=text)
    hit = _n_hit()
    kept = found.where(~((hit >= min_hit) & (hit >= share * F.col("__n_words"))))
    schema = T.StructType(docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            spans = batch.column("__spans").to_pylist()
            texts = [without(t, s) if s else t for t, s in zip(batch.column(text).to_pylist(), spans)]
            columns = list(batch.columns)[: len(schema)]
            columns[at] = pa.array(texts, columns[at].type)
            if size in schema.names:
                k = schema.names.index(size)
                columns[k] = pa.array([len(t) if s else n for t, s, n in zip(texts, spans, columns[k].to_pylist())],
                                      columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(cut, schema)


def without(text: str, spans: list[int]) -> str:
    """The text without the words of the spans and what stands between and after them."""
    data = text.encode()
    places = [m.span() for m in _PIECES.finditer(data.translate(PLAIN_TABLE))]
    out, at = [], 0
    for s, e in zip(spans[::2], spans[1::2]):
        out.append(data[at : places[s][0]])
        at = places[e][0] if e < len(places) else len(data)
    return b"".join([*out, data[at:]]).decode()
