"""Baseline, state and their companions as one versioned store.

Every run writes its tables into folders of its own, under a fresh name, and
then publishes them all by one small pointer file. A reader resolves the newest
pointer and reads the folders it names. Whatever a run wrote before it stopped
is named by no pointer, so nothing is half-written to a reader, and baseline
and high-water mark move together or not at all.

    <path>/_commits/00000000000000000012.json   the pointers, one a version
    <path>/runs/<run key>-<attempt>/<table>/    what a run wrote

A pointer is put in place by a rename that fails if the version exists: of two
runs that began at one version the later one to publish gets
:class:`CommitConflict` and is to be run again (on object stores without an
atomic rename, run one writer at a time). Run keys make a rerun after success a
no-op. A pointer lists the folders of each table and the counts of each run,
about a hundred bytes a run; :meth:`Store.compact` folds a table's folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CommitConflict(RuntimeError):
    """Another run published since this one began; run it again."""


@dataclass(frozen=True)
class Commit:
    version: int = -1  # -1: nothing was published yet
    tables: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    runs: Mapping[str, Mapping[str, int]] = field(default_factory=dict)


class Files:
    """Small files through the file system Spark reads the path with."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._none = spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._fs = self.path(path).getFileSystem(self._conf)

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self.path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Puts a whole file at ``path``; False if there is one already."""
        passing = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self._fs.create(self.path(passing), True)
        out.write(bytearray(text.encode()))
        out.close()
        there, here = (self._fs.makeQualified(self.path(p)) for p in (passing, path))
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(here.toUri(), self._conf).rename(there, here, self._none)
        except Py4JJavaError as e:
            self._fs.delete(there, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)

    def _pointer(self, version: int) -> str:
        return f"{self.path}/_commits/{version:020d}.json"

    def latest(self) -> Commit:
        names = [n for n in self.files.names(f"{self.path}/_commits") if n.endswith(".json")]
        if not names:
            return Commit()
        c = json.loads(self.files.read(f"{self.path}/_commits/{max(names)}"))
        return Commit(c["version"], {k: tuple(v) for k, v in c["tables"].items()}, c["runs"])

    def read(self, table: str, schema: T.StructType, at: Commit | None = None) -> DataFrame:
        """A table as of a commit (the latest); empty if it was never written."""
        folders = (at or self.latest()).tables.get(table, ())
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def begin(self, run_key: str) -> "Run":
        return Run(self, run_key)

    def compact(self, table: str, schema: T.StructType, run_key: str) -> Commit:
        """Rewrites a table's folders as one. Old folders stay for readers of
        earlier versions until :meth:`vacuum`."""
        run = self.begin(run_key)
        _, folder, _ = run.write(table, self.read(table, schema, run.base))
        run.replace(table, folder)
        return run.publish({})

    def vacuum(self) -> int:
        """Deletes runs' folders and pointers that the newest pointer does not
        need. Only while no run is under way and no old version is read."""
        now = self.latest()
        used = {f.split("/")[1] for folders in now.tables.values() for f in folders}
        gone = [n for n in self.files.names(f"{self.path}/runs") if n not in used]
        for name in gone:
            self.files.delete(f"{self.path}/runs/{name}")
        for name in self.files.names(f"{self.path}/_commits"):
            if now.version >= 0 and name != self._pointer(now.version).rsplit("/", 1)[1]:
                self.files.delete(f"{self.path}/_commits/{name}")
        return len(gone)


class Run:
    """One run's writes: nothing is visible before :meth:`publish`."""

    def __init__(self, store: Store, key: str):
        self.store, self.key = store, key
        self.base = store.latest()
        self._folder = f"runs/{quote(key, safe='')}-{uuid.uuid4().hex}"
        self._appended: dict[str, list[str]] = {}
        self._replaced: dict[str, list[str]] = {}

    @property
    def done(self) -> Mapping[str, int] | None:
        """The counts that an earlier run of this key published."""
        return self.base.runs.get(self.key)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        return self.store.read(table, schema, self.base)

    def write(self, name: str, rows: DataFrame, by: str | None = None, **counts: Column) -> tuple[DataFrame, str, dict[str, int]]:
        """Writes rows once; returns them read back, their folder and the counts
        that were observed while writing (``rows`` and those asked for).
        ``by`` splits the folder by a column's values."""
        folder = f"{self._folder}/{name}"
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        aggregates = {"rows": F.count(F.lit(1)), **counts}
        observed = rows.observe(seen, *[c.cast("long").alias(n) for n, c in aggregates.items()])
        writer = observed.write.partitionBy(by) if by else observed.write
        writer.parquet(f"{self.store.path}/{folder}")
        found = seen.get  # empty if the optimizer found that there are no rows
        back = self.store.spark.read.schema(rows.schema).parquet(f"{self.store.path}/{folder}")
        return back, folder, {n: int(found.get(n) or 0) for n in aggregates}

    def append(self, table: str, folder: str) -> None:
        self._appended.setdefault(table, []).append(folder)

    def replace(self, table: str, folder: str | None) -> None:
        self._replaced[table] = [folder] if folder else []

    def discard(self, folder: str) -> None:
        self.store.files.delete(f"{self.store.path}/{folder}")

    def publish(self, counts: Mapping[str, int]) -> Commit:
        tables = {k: list(v) for k, v in self.base.tables.items()}
        for name, folders in self._replaced.items():
            tables[name] = list(folders)
        for name, folders in self._appended.items():
            tables[name] = tables.get(name, []) + folders
        version = self.base.version + 1
        runs = {**{k: dict(v) for k, v in self.base.runs.items()}, self.key: dict(counts)}
        if not self.store.files.create(self.store._pointer(version), json.dumps({"version": version, "tables": tables, "runs": runs})):
            raise CommitConflict(f"{self.store.path}: version {version} was published by another run since run {self.key!r} began")
        return Commit(version, {k: tuple(v) for k, v in tables.items()}, runs)
