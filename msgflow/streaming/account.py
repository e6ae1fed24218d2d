"""Small tables that every batch of a stream brings up to date: accounts of offsets, profiles, samples, sketches."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.offsets import STRETCH, offset_account
from ..operators.profile import topic_profile
from .batches import BatchWriter, Report, log_counts
from .published import OutputLog

PROFILE = "topic string, partition int, first_offset bigint, end_offset bigint, messages bigint"

#: What a table becomes by a batch; the table is None before the first one.
Update = Callable[[DataFrame | None, DataFrame], DataFrame]


class KeptTable(BatchWriter):
    """A table that each batch replaces by its update, published as a whole in a log of its own.

    A batch that runs again starts from the table before it, so it counts once. The first batch of a new checkpoint starts from the last table.
    A ``small`` table, one that stays small however many messages there are, becomes one file; it is put together by all tasks
    before. Any other is written by the tasks that hold its rows.
    """

    def __init__(
        self, path: str, log: OutputLog, schema: str, update: Update, report: Report = log_counts, *, small: bool = True
    ):
        self.path = path.rstrip("/")
        self.log = log
        self.schema = schema
        self.update = update
        self.report = report
        self.small = small

    def sides(self) -> list[str]:
        return [self.path]

    def process(self, batch: DataFrame, batch_id: int) -> Mapping[str, int]:
        spark = batch.sparkSession
        before = _last_files(spark, self.path, self.log, self.attempt.run, batch_id)
        known = spark.read.schema(self.schema).parquet(*before) if before else None
        table = self.update(known, batch)
        # Unlike a coalesce, the shuffle leaves the windows, sorts and joins of the update to as many tasks as they have.
        self.put(table.repartition(1) if self.small else table, self.path, batch_id)
        return {"seen": 1}


def _last_files(spark: SparkSession, path: str, log: OutputLog, run: str = "", batch_id: int | None = None) -> list[str]:
    """The files of the last table, or of the last one before a batch of a run."""
    files = log.files(spark).where(F.col("side") == path)
    if batch_id is not None:
        files = files.where((F.col("run") != run) | (F.col("batch_id") < batch_id))
    last = files.agg(F.max("version")).first()[0]
    return [] if last is None else [r["path"] for r in files.where(F.col("version") == last).select("path").collect()]


def read_kept(spark: SparkSession, path: str, log: OutputLog, schema: str) -> DataFrame:
    """The table after the last published batch; empty before the first one."""
    paths = _last_files(spark, path.rstrip("/"), log)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


class OffsetAccounts(KeptTable):
    """Adds the offsets of every batch to a stored account. What a new checkpoint reads again is found to be repeated.

    An account grows with the holes of a topic, and a batch that has every fourth offset is all holes, so no task takes it whole.
    """

    def __init__(self, path: str, log: OutputLog, report: Report = log_counts):
        super().__init__(path, log, STRETCH, lambda known, batch: offset_account(batch, known), report, small=False)


def read_account(spark: SparkSession, path: str, log: OutputLog) -> DataFrame:
    return read_kept(spark, path, log, STRETCH)


def upserted(keys: list[str]) -> Update:
    """An update by which the rows of a batch take the place of those with the same keys; null keys are like others."""

    def update(known: DataFrame | None, batch: DataFrame) -> DataFrame:
        if known is None:
            return batch
        new = batch.select(*[F.col(key).alias(f"_{key}") for key in keys])
        same = F.lit(True)
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
        return known.join(new, same, "left_anti").unionByName(batch)

    return update


def profile_stream(
    messages: DataFrame, path: str, log: OutputLog, checkpoint: str, *, trigger: Mapping | None = None
) -> StreamingQuery:
    """``topic_profile`` of a stream, kept up to date: the aggregation's state is in the checkpoint, so every message is read once.

    A batch brings the partitions it has changed, which are put into the kept table (``read_kept`` with ``PROFILE``).
    """
    write = KeptTable(path, log, PROFILE, upserted(["topic", "partition"]))
    writer = topic_profile(messages).writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
