"""Output that readers see batch by batch: files are written first, and one log entry makes all sides of a batch visible at once.

A batch writes its sides (good rows, bad rows, dead letters) into folders that no earlier attempt has used. Its entry in the log
names the files of every side; creating it is a rename that fails if the name is taken, so an entry is there whole or not at all. A batch that runs
again publishes an entry that takes the place of the first one. No file is overwritten, so a reader keeps the version it began with.

The log is a folder of small JSON files, one a version. Every ``STATE_EVERY`` versions the files that are visible then are stored as a table, so a
snapshot reads that table and the entries after it. The file system must offer a rename that does not overwrite, as Spark's
own checkpoints do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..parquet import PARQUET_OPTIONS
from ..session import delete_folder

#: Versions after which the visible files are stored, so that a snapshot reads no more entries than that.
STATE_EVERY = 100

_ENTRY = (
    "version bigint, run string, batch_id bigint, sides array<string>, "
    "files array<struct<side: string, path: string, bytes: bigint>>, removed array<string>"
)
_FILES = "side string, path string, bytes bigint, run string, batch_id bigint, version bigint"


class File(NamedTuple):
    side: str
    path: str
    bytes: int


class Taken(Exception):
    """The version was published by someone else."""


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def written_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path and size of the Parquet files of a folder that one write has made."""
    location, system = _file_system(spark, folder)
    found = [(f"{folder}/{f.getPath().getName()}", f.getLen()) for f in system.listStatus(location)]
    return [(path, size) for path, size in found if path.endswith(".parquet")]


class OutputLog:
    """The log of the outputs that are published together; ``path`` is a folder of its own."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _versions(self, spark: SparkSession, folder: str, suffix: str) -> list[int]:
        location, system = _file_system(spark, folder)
        if not system.exists(location):
            return []
        names = [f.getPath().getName() for f in system.listStatus(location)]
        return sorted(int(n.removesuffix(suffix)) for n in names if n.endswith(suffix) and n.removesuffix(suffix).isdigit())

    def latest(self, spark: SparkSession) -> int:
        """The last version, or -1."""
        return max(self._versions(spark, f"{self.path}/entries", ".json"), default=-1)

    def _entry(self, version: int) -> str:
        return f"{self.path}/entries/{version:020d}.json"

    def create(self, spark: SparkSession, version: int, content: dict) -> None:
        """Creates the entry of a version, or raises ``Taken``."""
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}"
        location, system = _file_system(spark, draft)
        target = spark._jvm.org.apache.hadoop.fs.Path(self._entry(version))
        system.mkdirs(target.getParent())
        out = system.create(location)
        out.write(bytearray(json.dumps({"version": version, **content}).encode()))
        out.close()
        fs = spark._jvm.org.apache.hadoop.fs
        options = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        context = fs.FileContext.getFileContext(location.toUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(location, target, options)
        except Py4JJavaError as error:
            system.delete(location, False)
            if system.exists(target):
                raise Taken(f"version {version} of {self.path}") from error
            raise

    def publish(
        self, spark: SparkSession, run: str, batch_id: int, sides: Sequence[str], files: Iterable[File]
    ) -> int:
        """Makes these files what readers see of a batch on these sides, in place of what was there; returns the version."""
        content = {"run": run, "batch_id": batch_id, "sides": sorted(sides), "files": [f._asdict() for f in files], "removed": []}
        while True:
            version = self.latest(spark) + 1
            try:
                self.create(spark, version, content)
            except Taken:
                continue  # a query that shares the log was faster; batches of different queries do not touch each other
            break
        self._store_state(spark, version)
        return version

    def replace(self, spark: SparkSession, base: int, files: Sequence[File], removed: Sequence[str]) -> int | None:
        """Puts files into the place of others that hold the same rows and returns the version, or does nothing and returns None.

        ``base`` is the version from which the others were read. If one of them is no longer visible, its batch has run
        again meanwhile, and the new files hold what it had before.
        """
        content = {"run": "replaced", "batch_id": base, "sides": [], "files": [f._asdict() for f in files], "removed": list(removed)}
        while True:
            version = self.latest(spark)
            if version > base:
                gone = spark.createDataFrame([(path,) for path in removed], "path string")
                if not gone.join(self.files(spark, version), "path", "left_anti").isEmpty():
                    return None
                base = version
            try:
                self.create(spark, version + 1, content)
            except Taken:
                continue
            self._store_state(spark, version + 1)
            return version + 1

    def _state(self, version: int) -> str:
        return f"{self.path}/states/{version}"

    def _store_state(self, spark: SparkSession, version: int) -> None:
        if version % STATE_EVERY == STATE_EVERY - 1:
            # A table that is there counts only once Spark has marked its write as done.
            self.files(spark, version).write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(self._state(version))

    def _stored_state(self, spark: SparkSession, version: int) -> int:
        for found in reversed(self._versions(spark, f"{self.path}/states", "")):
            if found <= version:
                location, system = _file_system(spark, f"{self._state(found)}/_SUCCESS")
                if system.exists(location):
                    return found
        return -1

    def files(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """(side, path, bytes, run, batch_id, version) of the files visible at a version, by default the last one."""
        version = self.latest(spark) if version is None else version
        state = self._stored_state(spark, version)
        stored = spark.read.schema(_FILES).parquet(self._state(state)) if state >= 0 else spark.createDataFrame([], _FILES)
        if state >= version:
            return stored
        entries = spark.read.schema(_ENTRY).json([self._entry(v) for v in range(state + 1, version + 1)])
        added = entries.select(F.inline("files"), "run", "batch_id", "version")
        known = stored.unionByName(added)
        # Of a batch's side the last entry that speaks of it counts.
        owned = entries.select("run", "batch_id", F.explode("sides").alias("side"), "version")
        owned = owned.groupBy("run", "batch_id", "side").agg(F.max("version").alias("last"))
        current = known.join(owned, ["run", "batch_id", "side"], "left").where("last is null or version >= last")
        removed = entries.select(F.explode("removed").alias("path"))
        return current.join(removed, "path", "left_anti").select(*known.columns)

    def paths(self, spark: SparkSession, side: str, version: int | None = None) -> list[str]:
        """The visible files of a side; the list is what Spark's own file index holds of a folder."""
        found = self.files(spark, version).where(F.col("side") == side.rstrip("/")).select("path").collect()
        return sorted(row["path"] for row in found)

    def read(self, spark: SparkSession, side: str, version: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The rows of a side at a version; later batches do not change it. Folder names do not become columns."""
        paths = self.paths(spark, side, version)
        if not paths:
            if schema is None:
                raise ValueError(f"no published rows in {side}; give a schema to read it as empty")
            return spark.createDataFrame([], schema)
        reader = spark.read.option("recursiveFileLookup", "true")
        return (reader.schema(schema) if schema is not None else reader).parquet(*paths)

    def remove_unseen(self, spark: SparkSession, oldest: int) -> int:
        """Deletes files that no version from ``oldest`` on shows any more; readers of earlier versions lose them."""
        latest = self.latest(spark)
        kept = self.files(spark, oldest).select("path")
        entries = spark.read.schema(_ENTRY).json([self._entry(v) for v in range(latest + 1)])
        named = entries.select(F.inline("files"), "version")
        kept = kept.union(named.where(F.col("version") > oldest).select("path"))
        unseen = [r["path"] for r in named.select("path").join(kept, "path", "left_anti").distinct().collect()]
        for path in unseen:
            delete_folder(spark, path)
        return len(unseen)


class Attempt:
    """The files that one attempt at a batch has written, until they are published or given up."""

    def __init__(self, spark: SparkSession, log: OutputLog, run: str, batch_id: int):
        self.spark, self.log, self.run, self.batch_id = spark, log, run, batch_id
        self.name = uuid.uuid4().hex
        self.files: list[File] = []
        self.folders: list[str] = []

    def write(self, rows: DataFrame, side: str, folder: str | None = None) -> None:
        """Writes rows of a side into a folder of this attempt, below ``folder`` (by default the side's own)."""
        side = side.rstrip("/")
        target = f"{(folder or side).rstrip('/')}/run={self.run}/batch_id={self.batch_id}/attempt={self.name}"
        self.folders.append(target)
        rows.write.options(**PARQUET_OPTIONS).mode("append").parquet(target)
        known = {file.path for file in self.files}
        self.files += [File(side, path, size) for path, size in written_files(self.spark, target) if path not in known]

    def publish(self, sides: Sequence[str]) -> int:
        return self.log.publish(self.spark, self.run, self.batch_id, [side.rstrip("/") for side in sides], self.files)

    def give_up(self) -> None:
        for folder in self.folders:
            delete_folder(self.spark, folder)
        self.files, self.folders = [], []
