"""Chat formatting: roles by a hidden Markov model over lines, then canonical rendering.

A transcript is an ordered list of entries (turns) of lines. A state is a role, at the first line of a turn or
inside it. A line's features are the speaker marker it begins with, whether an entry begins there, its
length, how it ends, and what it begins with; they are independent given the state. Start, transition and
feature counts come from the labelled transcripts in Spark; Viterbi recovers the states.

Transcripts of any length are cut into chunks of at most ``CHUNK`` consecutive entries, whatever their turn numbers:
entries are sorted over range partitions, and a chunk's number is the position there divided by ``CHUNK``. The ranges
are of transcript, turn and the first ``PREFIX`` characters of the text. Each chunk becomes its matrix of best scores from any state before it to any state at its end; the matrices of a transcript
(one per chunk) give the states at the chunk borders, and each chunk is decoded between its own. So the lines of
a long transcript are never together in one task.

Defined cases: entries are ordered by turn (null first), then text. Equal entries of a transcript (turn and text) are
one, with their number in ``n_rows``; of several roles the smallest teaches. A null text is an empty line. Entries of a
null transcript id have no common order: each distinct one is a transcript of its own, not learned from. Markers are cut from the
rendered text. With nothing learned, all roles are ``user``. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import by_key, is_fold, not_fold, partitions, runs, small_batches, stored

CHUNK = 64
#: Characters of a text by which entries of one turn are dealt to ranges; Spark samples these values on the driver.
PREFIX = 128
MAX_ROLES = 32
ALPHA = 0.5
#: Speaker markers at the start of a line, by what they mean. Fixed values.
MARKERS = {
    "user": r"user|human|customer|question|q|you|me",
    "assistant": r"assistant|ai|bot|model|agent|answer|a",
    "system": r"system|instructions?|context",
}
_MARKER = re.compile(
    r"\s*(?:<\|(?:im_start\|>)?)?[\[#*]*\s*(?:" + "|".join(f"(?P<{k}>{v})" for k, v in MARKERS.items()) + r")\s*[\]*]*\s*(?::|>|\|>)\s*",
    re.IGNORECASE)
_KINDS = [None, *MARKERS]
#: Values of each feature: marker, entry start, length, end, beginning.
SIZES = (len(_KINDS), 2, 8, 5, 4)


def line_features(text: str | None) -> list[list[int]]:
    """The features of each line of one entry."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        mark = _MARKER.match(line)
        kind = _KINDS.index(mark.lastgroup) if mark else 0
        rest = line[mark.end() :] if mark else line
        words = len(rest.split())
        end = rest.rstrip()[-1:]
        head = rest.lstrip()[:1]
        out.append([kind, int(i == 0), min(7, words.bit_length()),
                    0 if not end else 1 if end == "?" else 2 if end in ".!" else 3 if end in ":;," else 4,
                    0 if not head else 1 if head.isupper() else 2 if head.islower() else 3])
    return out


def _entries(turns: DataFrame, conv: str, turn: str, role: str, text: str, labelled: bool = False) -> DataFrame:
    """Distinct entries: conv, turn, text, role, n_rows, and the chunk; ``labelled``: only those of a role and transcript."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"),
                        F.col(text).alias("text"))
    rows = rows.groupBy("conv", "turn", "text").agg(F.min("role").alias("role"), F.count("*").alias("n_rows"))
    named = rows.where("conv is not null")
    if labelled:
        named = named.where("role is not null")
    # positions grow along the ranges and inside them, so a transcript's chunks are in order
    named = (named.repartitionByRange(partitions(turns.sparkSession), "conv", "turn", F.substring("text", 1, PREFIX))
             .sortWithinPartitions("conv", "turn", "text")
             .withColumn("chunk", F.floor(F.monotonically_increasing_id() / CHUNK)))
    if labelled:
        return named
    return named.unionByName(rows.where("conv is null").withColumn("chunk", F.monotonically_increasing_id()))


class Model:
    """Log probabilities; states 2 * r (first line) and 2 * r + 1 (later lines) of role r."""

    def __init__(self, roles: list[str], start: np.ndarray, step: np.ndarray, lines: list[np.ndarray]):
        self.roles = roles
        n = len(roles)
        self.start = np.full(2 * n, -np.inf)
        self.start[::2] = np.log((start + ALPHA) / (start + ALPHA).sum())
        first = np.log((step + ALPHA) / (step + ALPHA).sum(axis=1, keepdims=True))
        self.lines = [np.log((x + ALPHA) / (x + ALPHA).sum(axis=1, keepdims=True)) for x in lines]
        # from any line of a turn: to its next line, or to the first line of a turn of any role; the features
        # tell which, so both are even here
        self.step = np.full((2 * n, 2 * n), -np.inf)
        for a in range(n):
            for at in (2 * a, 2 * a + 1):
                self.step[at, 2 * a + 1] = np.log(0.5)
                self.step[at, ::2] = np.log(0.5) + first[a]

    def emit(self, features: list[list[int]]) -> np.ndarray:
        x = np.array(features)
        return sum(self.lines[f][:, x[:, f]].T for f in range(len(SIZES)))

    def transfer(self, emit: np.ndarray) -> np.ndarray:
        """Best score from each state before the lines, and (last row) from the start, to each state at their end."""
        best = np.vstack([self.step, self.start]) + emit[0]
        for row in emit[1:]:
            best = (best[:, :, None] + self.step[None, :, :]).max(axis=1) + row
        return best

    def decode(self, emit: np.ndarray, before: int, end: int) -> np.ndarray:
        """States of the lines; ``before`` is the state before them (-1: none), ``end`` their last."""
        score = (self.start if before < 0 else self.step[before]) + emit[0]
        back = []
        for row in emit[1:]:
            through = score[:, None] + self.step
            back.append(through.argmax(axis=0))
            score = through.max(axis=0) + row
        at = end if end >= 0 else int(score.argmax())
        out = [at]
        for b in reversed(back):
            at = int(b[at])
            out.append(at)
        return np.array(out[::-1])


def train(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Model:
    """Counts of starts, turn-to-turn steps and line features of the labelled transcripts."""
    small_batches(turns.sparkSession)
    own = stored(_entries(turns, conv, turn, role, text, labelled=True), "chat-training")
    order = Window.partitionBy("conv", "chunk").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("text"))
    near = own.select("conv", "chunk", "role", F.lag("role").over(order).alias("before"), F.row_number().over(order).alias("nth"),
                      F.lead("role").over(order).alias("after"))
    inside = near.where("before is not null").groupBy("before", "role").agg(F.count("*").alias("n"))
    # across chunk borders: the last role of a chunk and the first of the next
    ends = near.groupBy("conv", "chunk").agg(F.max(F.when(F.col("nth") == 1, F.col("role"))).alias("first"),
                                             F.max(F.when(F.col("after").isNull(), F.col("role"))).alias("last"))
    chain = Window.partitionBy("conv").orderBy("chunk")
    border = ends.select("first", F.lag("last").over(chain).alias("before"))
    across = border.groupBy("before", F.col("first").alias("role")).agg(F.count("*").alias("n"))
    steps = inside.unionByName(across).groupBy("before", "role").agg(F.sum("n").alias("n"))
    lines = own.select("role", "text").mapInArrow(_count_lines, "role string, later int, feature int, value int, n long").groupBy(
        "role", "later", "feature", "value").agg(F.sum("n").alias("n"))
    roles = [r.role for r in own.select("role").distinct().orderBy("role").limit(MAX_ROLES + 1).collect()]
    if len(roles) > MAX_ROLES:
        raise ValueError(f"more than {MAX_ROLES} roles")
    roles = roles or ["user"]
    number = {r: i for i, r in enumerate(roles)}
    start, step = np.zeros(len(roles)), np.zeros((len(roles), len(roles)))
    for r in steps.collect():  # at most (MAX_ROLES + 1) x MAX_ROLES rows
        if r.before is None:
            start[number[r.role]] += r.n
        else:
            step[number[r.before], number[r.role]] += r.n
    counts = [np.zeros((2 * len(roles), s)) for s in SIZES]
    for r in lines.collect():  # at most MAX_ROLES x 2 x sum(SIZES) rows
        counts[r.feature][2 * number[r.role] + r.later, r.value] += r.n
    return Model(roles, start, step, counts)


def _count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, int] = {}
    for batch in batches:
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
            for i, features in enumerate(line_features(text)):
                for f, v in enumerate(features):
                    key = (role, int(i > 0), f, v)
                    held[key] = held.get(key, 0) + 1
    columns = list(zip(*held)) if held else [()] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int32()) for c in columns[1:]), pa.array(list(held.values()), pa.int64())],
        names=["role", "later", "feature", "value", "n"])


def render(role: str, text: str | None) -> str:
    """One canonical turn: a line with the role, the text without speaker markers, and a closing line."""
    lines = []
    for line in (text or "").split("\n"):
        mark = _MARKER.match(line)
        lines.append(line[mark.end() :] if mark else line)
    body = "\n".join(lines).strip()
    return f"<|{role}|>\n{body}\n<|end|>"


def _sorted_entries(group: pa.Table) -> list[int]:
    turn, text = group.column("turn").to_pylist(), group.column("text").to_pylist()
    return sorted(range(len(turn)), key=lambda i: (turn[i] is not None, turn[i] or 0, text[i] is not None, text[i] or ""))


def recover(turns: DataFrame, model: Model, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Each distinct entry with ``role_pred`` and ``rendered``."""
    spark = turns.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)
    own = _entries(turns, conv, turn, role, text).withColumn("key", F.xxhash64("conv", "chunk"))
    own = stored(own, "chat-entries")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, order in _chunks(batches):
            emit = held.value.emit([f for i in order for f in line_features(group.column("text")[i].as_py())])
            yield pa.RecordBatch.from_arrays(
                [group.column("conv").combine_chunks().slice(0, 1), group.column("chunk").combine_chunks().slice(0, 1),
                 pa.array([held.value.transfer(emit).tobytes()], pa.binary())], names=["conv", "chunk", "best"])

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        n = len(model.start)
        for _, group in runs(batches, "key"):
            by: dict = {}
            for c, k, best in zip(*(group.column(x).to_pylist() for x in ("conv", "chunk", "best"))):
                by.setdefault(c, []).append((k, np.frombuffer(best).reshape(n + 1, n)))
            for c, rows in by.items():
                rows.sort(key=lambda r: r[0])
                score = rows[0][1][-1]
                back = []
                for _, best in rows[1:]:
                    through = score[:, None] + best[:-1]
                    back.append(through.argmax(axis=0))
                    score = through.max(axis=0)
                at = int(score.argmax())
                ends = [at]
                for b in reversed(back):
                    at = int(b[at])
                    ends.append(at)
                ends = ends[::-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * len(rows), group.column("conv").type), pa.array([k for k, _ in rows], pa.int64()),
                     pa.array([-1, *ends[:-1]], pa.int32()), pa.array(ends, pa.int32())], names=["conv", "chunk", "before", "end"])

    kind = own.schema["conv"].dataType.simpleString()
    # transcripts of one chunk need no borders
    many = own.where("conv is not null").groupBy("conv").agg(F.min("chunk").alias("a"), F.max("chunk").alias("z")).where(
        "a < z").select("conv")
    long_ = own.join(many, "conv", "left_semi")
    table = by_key(long_, "key").mapInArrow(matrices, f"conv {kind}, chunk long, best binary")
    ends = by_key(table.withColumn("key", F.xxhash64("conv")), "key").mapInArrow(
        borders, f"conv {kind}, chunk long, before int, end int")
    ends = ends.withColumnRenamed("conv", "c").withColumnRenamed("chunk", "k")
    joined = own.join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left").drop("c", "k")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for group, order in _chunks(batches):
            lines = [line_features(group.column("text")[i].as_py()) for i in order]
            before, end = group.column("before")[0].as_py(), group.column("end")[0].as_py()
            states = model.decode(model.emit([f for own in lines for f in own]), -1 if before is None else before,
                                  -1 if end is None else end)
            at = np.cumsum([0, *(len(x) for x in lines)])[:-1]
            found = [model.roles[states[i] // 2] for i in at]
            rows = group.take(pa.array(order)).combine_chunks()
            texts = [render(r, t) for r, t in zip(found, rows.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(x).combine_chunks() for x in ("conv", "turn", "role", "n_rows")), pa.array(found, pa.string()),
                 pa.array(texts, pa.string())], names=["conv", "turn", "role", "n_rows", "role_pred", "rendered"])

    return by_key(joined, "key").mapInArrow(decode, f"conv {kind}, turn long, role string, n_rows long, role_pred string, rendered string")


def _chunks(batches: Iterator[pa.RecordBatch]):
    """The rows of one chunk, and their order."""
    for _, group in runs(batches, "key"):
        conv, chunk = group.column("conv").to_pylist(), group.column("chunk").to_pylist()
        apart: dict[tuple, list[int]] = {}
        for i, own in enumerate(zip(conv, chunk)):  # chunks whose keys collide
            apart.setdefault(own, []).append(i)
        for rows in apart.values():
            own = group if len(apart) == 1 else group.take(pa.array(rows))
            yield own, _sorted_entries(own)


def formatted(turns: DataFrame) -> DataFrame:
    """``op9``: learned from the other folds of transcripts, applied to every turn."""
    model = train(turns.where(not_fold("conv_id", 0)))
    return recover(turns, model).select(
        F.col("conv").alias("conv_id"), "turn", is_fold("conv", 0).alias("held_out"), "n_rows", "role_pred",
        F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"))
