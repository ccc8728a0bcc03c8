"""What the operators of this subpackage share: the split rule, Arrow batches, scratch tables."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.session import scratch_path

#: Text bytes that one vectorised step holds at a time; longer single texts are one step.
CHUNK_BYTES = 4 << 20
#: Partitions of small rows that one task writes to one file.
TOGETHER = 16


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int = 5) -> Column:
    """crc32 of the key's decimal text, modulo ``folds``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % folds


def is_fold(key: str | Column, number: int) -> Column:
    """True where the key falls in fold ``number``; a null key falls in none."""
    return F.coalesce(fold(key) == number, F.lit(False))


def not_fold(key: str | Column, number: int) -> Column:
    """True where the key falls in another fold; a null key falls in none."""
    return F.coalesce(fold(key) != number, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Get ready for Python tasks: ship this package to the workers, once a session, and bound the
    rows of an Arrow batch handed to Python, whatever the session's default is."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        package = Path(strata.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="strata-code-")) / "strata_code.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(target))  # served by the driver; workers fetch their copy


_SHIPPED: set[str] = set()


def stored(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage, survives executors.

    ``few`` is for rows small beside the input: a task of the last stage takes ``TOGETHER`` partitions, one after the
    other, where that leaves a task for each core. Each file costs the executor a process that sets its rights, which
    shares the executor's memory until it starts, so many small files cost memory.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if few:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, partitions(spark) // TOGETHER))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint folder as a path that workers can open.

    Memory-mapped files need a mounted shared folder; another kind of store is an error.
    """
    url = urlparse(scratch_path(spark, name))
    if url.scheme not in ("", "file"):
        raise RuntimeError(f"memory-mapped files need spark.checkpoint.dir on a mounted shared folder, not {url.scheme}://")
    return url.path


def shielded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For a function that returns its first argument's columns: those that begin with two underscores, as the
    operators' own do, have other names inside and their own again outside."""

    @wraps(stage)
    def go(docs: DataFrame, *args, **kwargs) -> DataFrame:
        inside = {c: f"shielded{i}_{c.strip('_')}" for i, c in enumerate(docs.columns) if c.startswith("__")}
        out = stage(docs.withColumnsRenamed(inside), *args, **kwargs)
        return out.withColumnsRenamed({v: k for k, v in inside.items()})

    return go


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes a piece (one row at least)."""
    yield from _cut(batches, column, limit)
    trim()


def trim() -> None:
    """Give memory that a finished task has freed back to the system; the worker process stays."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_KEPT: dict = {}


def kept(key, build: Callable):
    """A large object that a worker process keeps between tasks, until another one is asked for or room is made."""
    if key not in _KEPT:
        make_room()
        _KEPT[key] = build()
    return _KEPT[key]


def make_room() -> None:
    """Let go of what an earlier operator's tasks have kept in this worker process."""
    if _KEPT:
        _KEPT.clear()
        trim()


def _cut(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, total = 0, np.cumsum(lengths(batch.column(column)))
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 for null. A column of whole numbers holds them itself."""
    if pa.types.is_integer(column.type):
        return pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; empty for null."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Groups of equal keys from batches sorted by a non-null integer ``key``, one at a time."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        for a, z in zip(edges, edges[1:]):
            if held and keys[a] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = int(keys[a])
            held.append(batch.slice(a, z - a))
    if held:
        yield now, pa.Table.from_batches(held)
    held = []
    trim()


def by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of a key together and sorted, for ``runs`` inside ``mapInArrow``."""
    n = partitions(df.sparkSession)
    return df.repartition(n, key).sortWithinPartitions(key, *order)
