"""Lake versions: all tables of a lake change together, by one small manifest.

A version names, for every table, the folders that hold its rows. Data are written to new folders
first (``stage``); nothing refers to them until ``commit`` renames the next manifest into place.
A reader holds one version: its folders are never written again, so a build that is killed at any
point leaves every table as it was, and half-written folders are only removed by ``expire``. A commit
states the version it was made from; if another one came first, it fails and nothing changes.

Layout: ``<root>/<table>/[year=../month=../]batch=<id>/*.parquet`` and ``<root>/_versions/<number>.json``.
The batch level lets many folders of one partition live side by side under one base path, so partition
columns are restored and pruned as in any Hive-style table. A manifest has one line's worth per folder
(partitions times batches), never per row or file; ``compact`` merges the batches of a partition.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources.lake import MissingTable

BATCH = "batch"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class StaleVersion(RuntimeError):
    """Another commit came between reading a version and committing the next."""


@dataclass(frozen=True)
class Version:
    """A committed state: folders by table, relative to the table, and free-form properties."""

    number: int
    tables: dict[str, list[str]] = field(default_factory=dict)
    properties: dict = field(default_factory=dict)

    def folders(self, table: str, partitions: Iterable[str] | None = None) -> list[str]:
        """The table's folders; only those of some partitions (``year=2024/month=3``) when given."""
        own = self.tables.get(table, [])
        if partitions is None:
            return own
        wanted = set(partitions)
        return [f for f in own if partition_of(f) in wanted]


def partition_of(folder: str) -> str:
    return folder.rpartition("/")[0]


def partition_path(names: Sequence[str], values: Sequence) -> str:
    """``year=2024/month=3``, the folder of a partition; a null value has a name of its own."""
    return "/".join(f"{n}={NO_VALUE if v is None else v}" for n, v in zip(names, values))


class Lake:
    """Versioned tables below ``root``, a path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # ------------------------------------------------------------ manifests
    def _manifest(self, number: int) -> str:
        return f"{self.root}/_versions/{number:012d}.json"

    def numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def version(self, number: int | None = None) -> Version | None:
        """A committed version, the newest by default; ``None`` for a lake without any."""
        numbers = self.numbers()
        if number is None:
            if not numbers:
                return None
            number = numbers[-1]
        elif number not in numbers:
            raise MissingTable(f"{self.root} has no version {number}")
        stream = self._fs.open(self._path(self._manifest(number)))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return Version(**json.loads(text))

    def commit(self, base: Version | None, changes: dict[str, list[str]], properties: dict | None = None) -> Version:
        """The next version: ``base`` with the folder lists of ``changes`` in place of its own."""
        new = Version((base.number if base else 0) + 1, {**(base.tables if base else {}), **changes},
                      {**(base.properties if base else {}), **(properties or {})})
        body = json.dumps({"number": new.number, "tables": new.tables, "properties": new.properties}).encode()
        temporary = self._path(f"{self.root}/_versions/.{new.number:012d}-{uuid.uuid4().hex}")
        stream = self._fs.create(temporary, True)
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        if self.numbers()[-1:] > [new.number - 1]:
            self._fs.delete(temporary, False)
            raise StaleVersion(f"version {new.number} exists already")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self.spark._sc._gateway.new_array(getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(temporary, self._path(self._manifest(new.number)), options)  # never over an existing one
        except Py4JJavaError as exc:
            self._fs.delete(temporary, False)
            if "FileAlreadyExists" not in str(exc.java_exception):
                raise
            raise StaleVersion(f"version {new.number} exists already") from exc
        return new

    # ------------------------------------------------------------ data
    def stage(self, df: DataFrame, table: str, partition_by: Sequence[str] = (), dealt: bool = False) -> list[str]:
        """Write ``df`` to new folders of ``table`` and return them; they belong to no version yet. ``dealt``: its rows
        lie by partition already (read off folders of the same partitions), and need no shuffle."""
        batch = uuid.uuid4().hex[:16]
        rows = df.hint("rebalance", *partition_by) if partition_by and not dealt else df
        rows.withColumn(BATCH, F.lit(batch)).write.mode("append").partitionBy(*partition_by, BATCH).parquet(f"{self.root}/{table}")
        pattern = "/".join([self.root, table, *["*"] * len(partition_by), f"{BATCH}={batch}"])
        found = self._fs.globStatus(self._path(pattern)) or []
        return sorted("/".join(s.getPath().toString().split("/")[-len(partition_by) - 1:]) for s in found)

    def read_folders(self, table: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
        """The rows of some folders; no rows if there is none."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        full = StructType([*schema.fields, StructField(BATCH, StringType())])
        return (self.spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
                .select(*schema.fieldNames()))

    def read(self, table: str, schema: StructType, version: Version | None = None,
             partitions: Iterable[str] | None = None) -> DataFrame:
        """The table as of a version (the newest by default), or some of its partitions."""
        version = version or self.version()
        if version is None or table not in version.tables:
            raise MissingTable(f"{self.root}: no table {table}")
        return self.read_folders(table, schema, version.folders(table, partitions))

    # ------------------------------------------------------------ upkeep
    def compact(self, table: str, schema: StructType, partition_by: Sequence[str] = (), batches: int = 8) -> Version | None:
        """Merge the folders of every partition that has more than ``batches``; returns the new version, if any."""
        base = self.version()
        by: dict[str, list[str]] = {}
        for f in base.folders(table) if base else []:
            by.setdefault(partition_of(f), []).append(f)
        crowded = {f for own in by.values() if len(own) > batches for f in own}
        if not crowded:
            return None
        merged = self.stage(self.read_folders(table, schema, sorted(crowded)), table, partition_by)
        return self.commit(base, {table: sorted([f for f in base.folders(table) if f not in crowded] + merged)})

    def expire(self, keep: int = 1) -> int:
        """Forget all but the newest ``keep`` versions and delete folders that no kept version names, leftovers of
        killed builds among them. Not to be run beside a build. Returns the folders deleted."""
        numbers = self.numbers()
        kept = [self.version(n) for n in numbers[-keep:]]
        alive = {f"{t}/{f}" for v in kept for t, own in v.tables.items() for f in own}
        for n in numbers[:-keep]:
            self._fs.delete(self._path(self._manifest(n)), False)
        deleted = 0
        for status in self._fs.listStatus(self._path(self.root)):
            table = status.getPath().getName()
            if status.isDirectory() and not table.startswith("_"):
                for folder in self._batches(status.getPath(), ""):
                    if f"{table}/{folder}" not in alive:
                        self._fs.delete(self._path(f"{self.root}/{table}/{folder}"), True)
                        deleted += 1
        return deleted

    def _batches(self, folder, prefix: str) -> Iterable[str]:
        for status in self._fs.listStatus(folder):
            name = status.getPath().getName()
            if status.isDirectory() and not name.startswith(("_", ".")):
                if name.startswith(f"{BATCH}="):
                    yield prefix + name
                else:
                    yield from self._batches(status.getPath(), f"{prefix}{name}/")
