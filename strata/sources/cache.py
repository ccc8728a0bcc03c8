"""Results kept for a while (S13): by what was asked, of which data, and when.

A result is a Parquet folder in the shared scratch folder (or any other), so it outlives executors and serves
every session that names the same folder. It is used while the version of its data is the one asked for and its
age is below the time to live; otherwise it is built anew. Results that were replaced stay for one more life, for
readers that still hold them, and are then deleted.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.session import ensure_checkpoint_dir
from strata.sources.lake import write_table

#: Seconds that a result lives, as long as the dashboards keep one.
TTL = 3600


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """A version of some files or folders: changes when a file below them is added, removed or rewritten."""
    jvm, digest = spark._jvm, hashlib.sha256()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in sorted(paths):
        top = jvm.org.apache.hadoop.fs.Path(path)
        files = top.getFileSystem(conf).listFiles(top, True)
        found = []
        while files.hasNext():
            status = files.next()
            found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
        digest.update("\n".join(sorted(found)).encode())
    return digest.hexdigest()[:24]


class ResultCache:
    def __init__(self, spark: SparkSession, root: str | None = None, ttl: float = TTL, clock: Callable[[], float] = time.time):
        self.spark, self.ttl, self.clock = spark, ttl, clock
        self.root = (root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/results").rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _entries(self, folder: str) -> list[tuple[str, float, str]]:
        """Version, time and path of the finished results in a folder, oldest first."""
        if not self._fs.exists(self._path(folder)):
            return []
        out = []
        for status in self._fs.listStatus(self._path(folder)):
            name = status.getPath().getName()
            version, _, made = name.rpartition("@")
            if version and self._fs.exists(self._path(f"{folder}/{name}/_schema.json")):
                out.append((version, float(made), f"{folder}/{name}"))
        return sorted(out, key=lambda e: e[1])

    def get(self, name: str, version: str | int, build: Callable[[], DataFrame], params: dict | None = None,
            partition_by: Sequence[str] = ()) -> DataFrame:
        """The result ``name`` for ``params``, built if there is none of this version or it has expired."""
        asked = hashlib.sha256(json.dumps(params or {}, sort_keys=True, default=str).encode()).hexdigest()[:16]
        folder, now = f"{self.root}/{name}-{asked}", self.clock()
        entries = self._entries(folder)
        for own, made, path in reversed(entries):
            if own == str(version) and now - made < self.ttl:
                return self._read(path)
        df = build()
        path = f"{folder}/{version}@{now}"
        write_table(df, f"{path}/data", partition_by)
        stream = self._fs.create(self._path(f"{path}/_schema.json"), True)  # last: a result without it isn't finished
        try:
            stream.write(bytearray(df.schema.json().encode()))
        finally:
            stream.close()
        for _, made, old in entries:
            if now - made >= 2 * self.ttl:
                self._fs.delete(self._path(old), True)
        return self._read(path)

    def _read(self, path: str) -> DataFrame:
        stream = self._fs.open(self._path(f"{path}/_schema.json"))
        try:
            schema = StructType.fromJson(json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()
        return self.spark.read.schema(schema).parquet(f"{path}/data")
