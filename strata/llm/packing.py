"""Best-fit packing of token sequences, planned on a histogram of piece lengths.

Texts become token ids; a document of more than ``size`` ids is cut so that its first piece
takes the remainder and the others are full. Only the counts per length reach the driver
(at most ``size`` numbers). Best fit in decreasing length runs over these counts: bins with
equal contents form one range of sequence ids, so a length takes a few ranges however many
pieces have it. A piece finds its slot by its rank among the pieces of its length. Ranks come
from counts per (bucket, length), where a bucket is a hash of the document; so no length, however
common, is ranked in one task.

Defined cases: a null text is an empty one and gives the closing id alone; repeated rows and
null ids are documents of their own (equal rows are interchangeable); other columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import chunks, partitions, raw, small_batches, stored
from strata.llm.tokens import default_paths, encoder

SIZE = 1024
END = 2

_PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: tuple[str, str], size: int = SIZE, end: int = END) -> DataFrame:
    """One row per piece of each document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    small_batches(docs.sparkSession)
    closing = np.array([end], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(*vocabulary)
        for batch in chunks(batches, "text"):
            rows, numbers, starts, sizes, sums = [], [], [], [], []
            for row, ids in enumerate(tokens.encode(raw(batch.column("text")))):
                ids = np.concatenate([ids, closing])
                total = len(ids)
                at, k = 0, 0
                while at < total:
                    n = (total - at) % size or size
                    rows.append(row)
                    numbers.append(k)
                    starts.append(at)
                    sizes.append(n)
                    sums.append(zlib.crc32(ids[at : at + n]))
                    at, k = at + n, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (starts, sizes, sums))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, {_PIECES}")


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit in decreasing length over counts.

    Rows (length, first rank, ranks, first sequence, pieces a sequence, offset): the pieces of a
    length with these ranks go into consecutive sequences from the first on, so many to each,
    from this offset on. A piece goes where it leaves the least room.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    room: list[int] = []  # sorted; free places of each group of equal sequences
    groups: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, sequences)

    def put(free: int, first: int, n: int) -> None:
        if n and free:
            if free not in groups:
                groups[free] = []
                bisect.insort(room, free)
            groups[free].append((first, n))

    sequences = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            k = bisect.bisect_left(room, length)
            if k < len(room):
                free = room[k]
                first, n = groups[free].pop()
                if not groups[free]:
                    del groups[free], room[k]
            else:
                free, first = size, sequences
                n = -(-left // (size // length))
                sequences += n
            each = free // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, full * each, first, each, size - free))
                put(free - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:
                out.append((length, rank, left, first + full, left, size - free))
                put(free - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            put(free, first + full, n - full)
    return out


_PLAN = T.StructType([T.StructField(x, T.LongType()) for x in
                      ("p_length", "p_rank", "p_ranks", "p_sequence", "p_each", "p_offset")])


def pack(docs: DataFrame, vocabulary: tuple[str, str] | None = None, size: int = SIZE) -> DataFrame:
    """Contract of ``op10``: every piece with its sequence and place.

    The pieces are written once; their lengths are counted per bucket, summed to ranks, and
    planned. The plan has a few rows per length and is broadcast: its size depends on ``size``.
    """
    vocabulary = vocabulary or default_paths()
    spark = docs.sparkSession
    buckets = 4 * partitions(spark)
    cut = pieces(docs, vocabulary, size).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    cut = stored(cut, "packing-pieces")
    counts = stored(cut.groupBy("bucket", "length").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (cut.withColumn("own", F.row_number().over(own) - 1).join(ranks, ["bucket", "length"])
              .withColumn("rank", F.col("before") + F.col("own")))
    slots = spark.createDataFrame([tuple(map(int, r)) for r in plan(histogram, size)], _PLAN)
    place = F.col("rank") - F.col("p_rank")
    return ranked.join(F.broadcast(slots), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_rank"))
                       & (place < F.col("p_ranks"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("p_sequence") + F.floor(place / F.col("p_each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + place % F.col("p_each") * F.col("length")).cast("long").alias("offset"))
