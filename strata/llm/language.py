"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become code points: letters in lower case, everything else a space. Runs of two and three
of them, other than spaces alone, are hashed to ``FEATURES`` numbers. Counts per language are summed
in Spark over all training texts; the log-probability matrix (features by languages) is broadcast;
batches of texts are scored in numpy by the sum of the rows of their features.

The matrix has ``FEATURES`` rows and at most ``MAX_LANGUAGES`` columns of four bytes, which bounds
the broadcast; more languages are an error.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with nothing learned
every text is. A null id is in no fold, so its row isn't learned from and isn't held out. Null
languages teach nothing. Equal rows count each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunks, is_fold, not_fold, raw, small_batches

FEATURES = 1 << 15
MAX_LANGUAGES = 256
#: Added to every count.
ALPHA = 0.5
UNKNOWN = "und"
_BITS = FEATURES.bit_length() - 1
_PLANE = 0x20000
_BLOCK = 1 << 20
#: Bytes of text in one step; its features take about 60 times as much.
_STEP = 1 << 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter below ``_PLANE``, 32 for others."""
    return np.array([_letter(i) for i in range(_PLANE)], np.uint32)


def _letter(point: int) -> int:
    return ord(chr(point).lower()[0]) if chr(point).isalpha() else 32


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all texts one after the other, the bounds of each text's, and whether it has a letter."""
    # two spaces stand after each text, and no run begins in them: a text's features are its own
    points = np.frombuffer("  ".join([t.decode() for t in texts] + [""]).encode("utf-32-le"), np.uint32)
    size = np.array([len(t.decode()) + 2 for t in texts], np.int64)
    table = _letters()
    codes = table[np.minimum(points, _PLANE - 1)]
    far = points >= _PLANE
    if far.any():
        kinds, which = np.unique(points[far], return_inverse=True)
        codes[far] = np.array([_letter(int(x)) for x in kinds], np.uint32)[which]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    codes = np.concatenate([codes, np.full(2, 32, np.uint32)])
    blank = codes == 32
    out, where = [], []
    n = len(codes) - 2
    own = np.ones(n, bool)
    own[bounds[1:] - 1] = own[bounds[1:] - 2] = False
    for k in (2, 3):
        keys = codes[:n].copy()
        empty = blank[:n].copy()
        for i in range(1, k):
            keys = keys * np.uint32(0x01000193) + codes[i : i + n]
            empty &= blank[i : i + n]
        keys = (keys * np.uint32(0x9E3779B1)) ^ np.uint32(k * 0x05EBCA6B)
        keys ^= keys >> np.uint32(15)
        keys *= np.uint32(0x2C1B3C6D)
        out.append((keys >> np.uint32(32 - _BITS)).astype(np.int32))
        where.append(own & ~empty)
    both = np.stack(out, axis=1).reshape(-1)
    kept = np.stack(where, axis=1).reshape(-1)
    total = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(kept, out=total[1:])
    letter = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(~blank, out=letter[1:])
    return both[kept], total[2 * bounds], letter[bounds[1:]] > letter[bounds[:-1]]


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and their log priors (row 0) and log probabilities (rows 1 on) by feature."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in chunks(batches, "__text", _STEP):
            numbers, bounds, _ = features(raw(batch.column("__text")))
            for i, name in enumerate(batch.column("__lang").to_pylist()):
                if name not in held:
                    held[name] = np.zeros(FEATURES + 1, np.int64)
                held[name][0] += 1
            names, which = np.unique(batch.column("__lang").to_pylist(), return_inverse=True)
            of = np.repeat(which.astype(np.int16), np.diff(bounds))
            for i, name in enumerate(names.tolist()):
                held[name][1:] += np.bincount(numbers[of == i], minlength=FEATURES)
            if len(held) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                names=["lang", "feature", "n"])

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("__text"), F.col(lang).alias("__lang"))
    counted = rows.mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    # at most MAX_LANGUAGES x FEATURES rows
    table = counted.toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((FEATURES + 1, len(langs)))
    number = {name: i for i, name in enumerate(langs)}
    of = np.array([number[x] for x in table.column("lang").to_pylist()], int)
    counts[table.column("feature").to_numpy(), of] = table.column("n").to_numpy()
    weights = np.zeros((FEATURES + 1, len(langs)), np.float32)
    if langs:
        weights[0] = np.log(counts[0] / counts[0].sum())
        smooth = counts[1:] + ALPHA
        weights[1:] = np.log(smooth / smooth.sum(axis=0))
    return langs, weights


def score(texts: list[bytes], langs: list[str], weights: np.ndarray) -> tuple[list[str], list[float]]:
    """The likeliest language of each text and its posterior probability."""
    numbers, bounds, letter = features(texts)
    sums = np.zeros((len(texts), len(langs)))
    start = bounds[:-1]
    for j in range(len(langs)):
        column = np.ascontiguousarray(weights[1:, j])
        at = 0
        while at < len(texts):  # blocks of whole texts
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _BLOCK, side="right")) - 1)
            values = np.append(column[numbers[bounds[at] : bounds[end]]], np.float32(0)).astype(np.float64)
            part = np.add.reduceat(values, start[at:end] - bounds[at])
            sums[at:end, j] = np.where(np.diff(bounds[at : end + 1]) > 0, part, 0)
            at = end
    sums += weights[0]
    best = sums.argmax(axis=1)
    chance = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    return ([langs[b] if ok else UNKNOWN for b, ok in zip(best, letter)],
            [float(c) if ok else 0.0 for c, ok in zip(chance, letter)])


def identify(docs: DataFrame, langs: list[str], weights: np.ndarray, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (which replace columns of these names)."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast((langs, weights))
    docs = docs.drop("lang_pred", "score")
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weights = held.value
        for batch in chunks(batches, text, _STEP):
            texts = raw(batch.column(text))
            names, scores = score(texts, langs, weights) if langs else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(predict, schema)


def predictions(docs: DataFrame) -> DataFrame:
    """Contract of ``op2``: trained on the other folds, applied to every document."""
    langs, weights = train(docs.where(not_fold("doc_id", 0)))
    own = docs.select("doc_id", is_fold("doc_id", 0).alias("held_out"), "text")
    return identify(own, langs, weights).select("doc_id", "held_out", "lang_pred", "score")
