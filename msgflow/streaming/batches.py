"""Micro-batch writers for ``foreachBatch``.

Each batch goes to its own folder ``run=<query id>/batch_id=N`` and replaces what is there, so a batch that runs
again after a failure leaves one copy. The query id belongs to the checkpoint: a query that starts with a new
checkpoint counts from 0 again, below a folder of its own, and earlier runs stay readable next to it.

A writer with an ``OutputLog`` publishes instead: each attempt at a batch has folders of its own, and one entry of the log makes all sides
of the batch visible at once.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.compaction import compact
from ..operators.inference import counted_batch_schema, counted_recursive_schema, merge_schemas
from ..operators.policies import (
    CORRUPT,
    bad_rows,
    converted_of,
    converted_rows,
    good_rows,
    inferred_rows,
    parse_converted,
    parse_with_capture,
    rejected_of,
    conversion_measures,
    split_measures,
)
from ..operators.shape import align
from ..operators.summaries import schema_summary
from ..parquet import PARQUET_OPTIONS
from ..session import delete_folder
from ..sources.envelope import ORIGIN
from .failures import is_data_error
from .published import Attempt, OutputLog

logger = logging.getLogger(__name__)

Report = Callable[[int, Mapping[str, int]], None]


def log_counts(batch_id: int, counts: Mapping[str, int]) -> None:
    logger.info("batch %d: %s", batch_id, ", ".join(f"{name} {n}" for name, n in counts.items()))


def _run_id(spark: SparkSession) -> str | None:
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_folder(spark: SparkSession, path: str, batch_id: int) -> str:
    """The folder of a batch of the query that is running; outside of a query, of no run."""
    run = _run_id(spark)
    return f"{path}/run={run}/batch_id={batch_id}" if run else f"{path}/batch_id={batch_id}"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    folder = batch_folder(rows.sparkSession, path, batch_id)
    rows.write.options(**PARQUET_OPTIONS).mode("overwrite").parquet(folder)


def discard_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Removes what an earlier attempt at this batch has left."""
    delete_folder(spark, batch_folder(spark, path, batch_id))


def read_batches(spark: SparkSession, path: str, log: OutputLog | None = None, version: int | None = None) -> DataFrame:
    """The rows of all batches of all runs below a folder; folder names do not become columns.

    With a log, those that are published, as of the given version or the last one.
    """
    if log is not None:
        return log.read(spark, path, version)
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


@contextmanager
def _persisted(rows: DataFrame):
    rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


class BatchWriter:
    """A writer of batches that reports counts once a batch is written, and can take a batch back.

    With a ``log`` the batch is published when all its sides are written, and is not visible before.
    """

    report: Report
    log: OutputLog | None = None
    attempt: Attempt | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.reported(batch_id, self.attempted(batch, batch_id, ()))

    def attempted(self, batch: DataFrame, batch_id: int, others: Sequence[str]) -> Mapping[str, int]:
        """``process``, and publication of what it wrote; ``others`` are sides on which the batch has nothing."""
        if self.log is None:
            return self.process(batch, batch_id)
        spark = batch.sparkSession
        self.attempt = Attempt(spark, self.log, _run_id(spark) or "", batch_id)
        try:
            counts = self.process(batch, batch_id)
            if counts.get("seen"):
                self.attempt.publish([*self.sides(), *others])
            return counts
        except BaseException:
            self.attempt.give_up()
            raise
        finally:
            self.attempt = None

    def put(self, rows: DataFrame, side: str, batch_id: int, folder: str | None = None) -> None:
        """Writes rows of the batch that belong to a side, in ``folder`` or the side's own."""
        if self.attempt is not None:
            self.attempt.write(rows, side, folder)
        else:
            write_batch(rows, folder or side, batch_id)

    def reported(self, batch_id: int, counts: Mapping[str, int]) -> None:
        if counts.get("seen"):
            self.report(batch_id, counts)

    def sides(self) -> list[str]:
        """The folders of the writer's outputs."""
        raise NotImplementedError

    def process(self, batch: DataFrame, batch_id: int) -> Mapping[str, int]:
        """Writes the batch and returns its counts, without ``seen`` or with 0 for an empty one."""
        raise NotImplementedError

    def discard(self, batch: DataFrame, batch_id: int) -> None:
        """Removes whatever of the batch has been written; of a published batch an attempt takes care itself."""
        raise NotImplementedError


class SplitBatches(BatchWriter):
    """Good rows to one folder, bad rows to another, under a fixed schema; parsed once per batch.

    The counts are observed while the rows are written: two jobs a batch, of which the second reads the parsed rows from memory.
    """

    def __init__(
        self,
        schema: T.StructType,
        good_path: str,
        bad_path: str,
        report: Report = log_counts,
        log: OutputLog | None = None,
    ):
        self.schema = schema
        self.good_path = good_path
        self.bad_path = bad_path
        self.report = report
        self.log = log

    def sides(self) -> list[str]:
        return [self.good_path, self.bad_path]

    def process(self, batch: DataFrame, batch_id: int) -> Mapping[str, int]:
        counted = Observation()
        with _persisted(parse_with_capture(batch, self.schema)) as parsed:
            self.put(good_rows(parsed.observe(counted, *split_measures())), self.good_path, batch_id)
            if counted.get["bad"]:
                self.put(bad_rows(parsed), self.bad_path, batch_id)
            return counted.get

    def discard(self, batch: DataFrame, batch_id: int) -> None:
        for path in self.sides():
            discard_batch(batch.sparkSession, path, batch_id)


def dead_letter_batch(
    write: Callable[[DataFrame, int], None],
    error_path: str,
    discard: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Wraps a batch writer: a batch whose data it can not bear goes, unparsed and whole, to ``error_path``.

    What is no fault of the data (lost executors, a full disk, lack of memory, an unreachable store) is raised instead: the query stops,
    nothing of the batch is committed, and it runs again at the next start. See ``is_data_error``.

    A batch ends up in one place: after a failure, what has been written of it is discarded (``BatchWriter`` does
    that itself, for other functions pass ``discard``), and after a success, what a failed attempt has left in
    ``error_path``. A writer with a log publishes its dead letters there too. Counts are reported outside of the guard, so a report that
    fails is no failed batch.
    """
    writer = write if isinstance(write, BatchWriter) else None
    log = writer and writer.log

    def guarded(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            counts = writer.attempted(batch, batch_id, [error_path]) if writer else write(batch, batch_id)
        except Exception as error:
            if not is_data_error(error):
                raise
            # The message of the error may quote payload, so only its type is logged.
            logger.error("batch %d failed (%s), kept in %s", batch_id, type(error).__name__, error_path)
            if log is not None:
                kept = Attempt(spark, log, _run_id(spark) or "", batch_id)
                kept.write(batch, error_path)
                kept.publish([*writer.sides(), error_path])
                return
            write_batch(batch, error_path, batch_id)
            if undo := discard or (writer and writer.discard):
                undo(batch, batch_id)
            return
        if log is None:
            discard_batch(spark, error_path, batch_id)
        if writer:
            writer.reported(batch_id, counts)

    return guarded


class _SchemaLog:
    """The schemas a folder has been written with: an entry per change, in a small text file of its own.

    An entry has its version, the payload's schema and that of the written rows. Entries are only added, so a failure
    leaves the ones before it whole.
    """

    def __init__(self, path: str):
        self.path = f"{path.rstrip('/')}.schemas"

    def _entries(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.text(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def latest(self, spark: SparkSession) -> tuple[int, int, T.StructType] | None:
        """Number, version and payload schema of the last entry."""
        entries = self._entries(spark)
        last = entries and entries.orderBy(F.desc("entry")).first()
        if last is None:
            return None
        found = json.loads(last["value"])
        return last["entry"], found["version"], T.StructType.fromJson(found["payload"])

    def versions(self, spark: SparkSession) -> list[tuple[int, T.StructType]]:
        """Each version with the schema of its rows, after its last entry. A version is a change of a type."""
        entries = self._entries(spark)
        if entries is None:
            return []
        version = F.get_json_object("value", "$.version").cast("int").alias("version")
        found = entries.groupBy(version).agg(F.max_by("value", "entry").alias("value")).orderBy("version").collect()
        return [(r["version"], T.StructType.fromJson(json.loads(r["value"])["rows"])) for r in found]

    def add(self, spark: SparkSession, entry: int, version: int, payload: T.StructType, rows: T.StructType) -> None:
        text = json.dumps({"version": version, "payload": payload.jsonValue(), "rows": rows.jsonValue()})
        row = spark.range(0, 1, 1, 1).select(F.lit(text).alias("value"))
        row.write.mode("overwrite").text(f"{self.path}/entry={entry}")


def _only_adds(known: T.DataType, wider: T.DataType) -> bool:
    """Whether files with the first schema can be read with the second one: no type differs, fields are added at most."""
    if isinstance(known, T.StructType) and isinstance(wider, T.StructType):
        other = {field.name: field.dataType for field in wider.fields}
        return all(f.name in other and _only_adds(f.dataType, other[f.name]) for f in known.fields)
    if isinstance(known, T.ArrayType) and isinstance(wider, T.ArrayType):
        return _only_adds(known.elementType, wider.elementType)
    return known == wider


class InferredBatches(BatchWriter):
    """Schema inferred from every batch, rows with the envelope of their own message.

    With ``accumulate`` (the default) each batch is written with the schema of all batches so far,
    kept in a log next to the folder: fields are added and types widened, never lost, and
    ``read_versions`` reads the whole folder. Without it each batch keeps its own schema. Reported are the messages
    seen and, of the rows, those kept and those whose text stands in ``_corrupt_record``.
    """

    keep: Sequence[str] = ORIGIN

    def __init__(
        self, path: str, *, accumulate: bool = True, report: Report = log_counts, log: OutputLog | None = None
    ):
        self.path = path
        self.accumulate = accumulate
        self.report = report
        self.log = log
        self._log = _SchemaLog(path)
        self._latest: tuple[int, int, T.StructType] | None = None

    def sides(self) -> list[str]:
        return [self.path]

    def infer(self, batch: DataFrame) -> tuple[int, T.StructType]:
        """The number of messages and their schema."""
        return counted_batch_schema(batch, in_one_job=True)

    def _known(self, spark: SparkSession) -> tuple[int, int, T.StructType | None]:
        """Number and version of the last entry of the schema log, and the schema it names."""
        self._latest = self._latest or (self._log.latest(spark) if self.accumulate else None)
        return self._latest or (-1, 0, None)

    def rows(self, batch: DataFrame, schema: T.StructType) -> DataFrame:
        return inferred_rows(batch, schema, keep=(*self.keep,))

    def _folder(self, batch: DataFrame, schema: T.StructType) -> tuple[str, T.StructType]:
        """Where the batch goes, and the schema it is written with. A new version starts where a type changes."""
        if not self.accumulate:
            return self.path, schema
        spark = batch.sparkSession
        entry, version, known = self._known(spark)
        schema = merge_schemas(known, schema) if known is not None else schema
        if schema != known:
            version += known is not None and not _only_adds(known, schema)
            entry += 1
            self._log.add(spark, entry, version, schema, self.rows(batch, schema).schema)
        self._latest = entry, version, schema
        return f"{self.path}/schema_version={version}", schema

    def process(self, batch: DataFrame, batch_id: int) -> Mapping[str, int]:
        with _persisted(batch):
            n, schema = self.infer(batch)
            if not n:
                return {}
            folder, schema = self._folder(batch, schema)
            return self.write(batch, schema, folder, batch_id)

    def write(self, batch: DataFrame, schema: T.StructType, folder: str, batch_id: int) -> Mapping[str, int]:
        seen, written = Observation(), Observation()
        rows = self.rows(batch.observe(seen, F.count(F.lit(1)).alias("seen")), schema)
        corrupt = F.col(CORRUPT).isNotNull()
        rows = rows.observe(written, F.count_if(~corrupt).alias("kept"), F.count_if(corrupt).alias("rejected"))
        self.put(rows, self.path, batch_id, folder)
        return {**seen.get, **written.get}

    def discard(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folders = [f"{self.path}/schema_version={v}" for v, _ in self._log.versions(spark)] if self.accumulate else []
        for folder in folders or [self.path]:
            discard_batch(spark, folder, batch_id)


class ConvertedBatches(InferredBatches):
    """``InferredBatches`` with timestamp detection; messages it cannot use go to ``bad_path``.

    Rejected messages are counted whether or not ``bad_path`` is given. With ``summary_path`` every batch leaves a summary there, from which the
    schema of all batches follows (``summarized_schema``). A batch is parsed twice: to find its schema, and
    under the schema; both sides are written from the second one.
    """

    def __init__(
        self,
        path: str,
        bad_path: str | None = None,
        *,
        keep: Sequence[str] = (),
        accumulate: bool = True,
        report: Report = log_counts,
        log: OutputLog | None = None,
        summary_path: str | None = None,
    ):
        super().__init__(path, accumulate=accumulate, report=report, log=log)
        self.bad_path = bad_path
        self.summary_path = summary_path
        self.keep = keep

    def sides(self) -> list[str]:
        return [path for path in (self.path, self.bad_path, self.summary_path) if path]

    def infer(self, batch: DataFrame) -> tuple[int, T.StructType]:
        known = self._known(batch.sparkSession)[2]
        return counted_recursive_schema(batch, persist=True, known=known, in_one_job=True)

    def rows(self, batch: DataFrame, schema: T.StructType) -> DataFrame:
        return converted_rows(batch, schema, keep=self.keep)

    def write(self, batch: DataFrame, schema: T.StructType, folder: str, batch_id: int) -> Mapping[str, int]:
        counted = Observation()
        with _persisted(parse_converted(batch, schema)) as parsed:
            observed = parsed.observe(counted, *conversion_measures())
            if schema.fields:
                self.put(converted_of(observed, schema, keep=self.keep), self.path, batch_id, folder)
            else:
                observed.write.format("noop").mode("overwrite").save()  # no field, so no row of this batch fits
            if self.bad_path and counted.get["rejected"]:
                self.put(rejected_of(parsed, keep=ORIGIN), self.bad_path, batch_id)
            if self.summary_path:
                self.put(schema_summary(batch).coalesce(1), self.summary_path, batch_id)
            return counted.get

    def discard(self, batch: DataFrame, batch_id: int) -> None:
        super().discard(batch, batch_id)
        for path in self.sides()[1:]:
            discard_batch(batch.sparkSession, path, batch_id)


def _version_parts(
    spark: SparkSession, path: str, log: OutputLog | None = None, at: int | None = None
) -> list[tuple[int, T.StructType, list[str]]]:
    """Version, schema of its rows and where they are, of those versions that have rows.

    A batch that failed after its schema was logged leaves a version without any. Without a log the rows are in the version's folder, with
    one in the files that are published.
    """
    published = log.paths(spark, path, at) if log is not None else []
    found = []
    for version, schema in _SchemaLog(path).versions(spark):
        folder = f"{path}/schema_version={version}"
        if log is not None:
            parts = [file for file in published if file.startswith(f"{folder}/")]
        else:
            location = spark._jvm.org.apache.hadoop.fs.Path(folder)
            parts = [folder] if location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location) else []
        if parts:
            found.append((version, schema, parts))
    return found


def compact_versions(spark: SparkSession, path: str, target: str) -> None:
    """The folder of ``InferredBatches`` with the same rows in larger files, each version under its own schema.

    ``read_versions`` reads the result; the schema log is copied with its last entry per version.
    """
    log = _SchemaLog(target)
    for entry, (version, schema, (folder,)) in enumerate(_version_parts(spark, path)):
        compact(spark, folder, f"{target}/schema_version={version}", ignore_folders=True, schema=schema)
        log.add(spark, entry, version, schema, schema)


def read_versions(
    spark: SparkSession, path: str, *, exact: bool = False, log: OutputLog | None = None, version: int | None = None
) -> DataFrame:
    """All rows of an ``InferredBatches`` folder under its latest schema; with a log, those published as of a version.

    Files are read version by version with the types of their version, and cast to the latest ones; there are as many
    reads as there were changes of a type. A timestamp that later became text reads as ISO text in UTC, whatever the
    session's zone. Integers that later met a fraction read as doubles, which cannot hold all integers
    beyond 2**53; with ``exact`` such columns are read as text instead, every number as it was written.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    parts = [reader.schema(schema).parquet(*found) for _, schema, found in _version_parts(spark, path, log, version)]
    if not parts:
        raise ValueError(f"no batches below {path}")
    merge = partial(merge_schemas, exact=exact)
    target = reduce(merge, [part.schema for part in parts])
    order = [name for name in target.names if name != CORRUPT]
    target = T.StructType([target[name] for name in (*order, *([CORRUPT] if CORRUPT in target.names else []))])

    def widened(part: DataFrame) -> DataFrame:
        known = {f.name: f.dataType for f in part.schema.fields}
        return part.select(
            *[
                align(F.col(f"`{f.name}`"), known[f.name], f.dataType).alias(f.name)
                if f.name in known
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in target.fields
            ]
        )

    return reduce(DataFrame.unionByName, [widened(part) for part in parts])
