"""Sources other than a broker: replayed envelopes, literal texts, binary files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .envelope import ENVELOPE

#: What a core reads of a micro-batch; the size of a split in Spark's file sources.
SPLIT_BYTES = 128 * 1024 * 1024


def replay_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Stream over a directory of envelope-shaped Parquet; new files become new messages.

    One of the two limits bounds a batch, by number or by size of its files.
    """
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def replay_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)


def bytes_per_batch(spark: SparkSession, path: str, batches: int = 1, split_bytes: int = SPLIT_BYTES) -> int:
    """A bound for the micro-batches over a directory: a split for every core, or a share of the directory where that is less."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    total = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(1, min(total // batches, spark.sparkContext.defaultParallelism * split_bytes))


def literal_messages(spark: SparkSession, texts: Sequence[str | None]) -> DataFrame:
    """A handful of texts given in code, as column ``json_string``."""
    return spark.createDataFrame([(text,) for text in texts], "json_string string")


def binary_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files as rows: path, modificationTime, length, content.

    Leave ``content`` out of a projection and the bytes are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)
