"""A representative sample of messages: those with the least hashes of their coordinates.

Which messages are taken does not depend on how they are partitioned or in which batches they come, and samples of parts
make the sample of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COORDINATES = ("kafka_topic", "kafka_partition", "kafka_offset")
SAMPLE = "kafka_topic string, kafka_partition int, kafka_offset bigint, json_string string, digest string"


def _digest() -> Column:
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in COORDINATES]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def message_sample(wide: DataFrame, k: int) -> DataFrame:
    """The k messages of a wide envelope with the least digests, in one pass: every task keeps k rows, and nothing is sorted as a whole.

    A message that repeats counts once per copy here, and once in ``merged_sample``.
    """
    rows = wide.select(*COORDINATES, "json_string").withColumn("digest", _digest())
    return rows.orderBy("digest", "json_string").limit(k)


def merged_sample(samples: DataFrame, k: int) -> DataFrame:
    """The sample of all messages from samples of their parts, each of k messages or all there were."""
    once = samples.groupBy(*COORDINATES, "digest").agg(F.min("json_string").alias("json_string"))
    return once.select(*samples.columns).orderBy("digest").limit(k)
