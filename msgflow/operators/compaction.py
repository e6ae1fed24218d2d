"""Many small Parquet files into few of a target size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..parquet import PARQUET_OPTIONS

# Fixed value: the file size to aim for.
TARGET_BYTES = 128 * 1024 * 1024


def packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session whose file scans pack small files into splits of the target size, without a shuffle."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    # A file counts with its size only, so that one pass is enough for files of any size.
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    target_bytes: int = TARGET_BYTES,
    partition_by: Sequence[str] = (),
    ignore_folders: bool = False,
    schema: T.StructType | None = None,
) -> None:
    """Copies a Parquet dataset into another folder, in files of about ``target_bytes``.

    Without partition columns there is no shuffle: the scan packs small files into splits of the
    target size and each split is written as one file, however many files that takes. With partition columns the
    rows are rebalanced by them; a large partition is spread over several tasks, so over several files.
    ``ignore_folders`` keeps folder names such as ``batch_id=7`` from becoming columns. Files that lack some of the
    fields are read under ``schema``; for the output of ``InferredBatches`` see ``streaming.compact_versions``.
    """
    session = packing_session(spark, target_bytes)
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    reader = session.read.option("recursiveFileLookup", str(ignore_folders).lower())
    rows = (reader.schema(schema) if schema is not None else reader).parquet(source)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.options(**PARQUET_OPTIONS).partitionBy(*partition_by).parquet(target)
