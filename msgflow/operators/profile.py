"""What a topic holds, by partition and offset: aggregations over the envelope columns alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_profile(envelope: DataFrame) -> DataFrame:
    """First offset, end offset (one past the last) and exact message count per topic partition."""
    return envelope.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("messages"),
    )


def topic_totals(envelope: DataFrame) -> DataFrame:
    """Per topic: partitions, sum of end offsets, and messages.

    The sum of end offsets is the usual estimate of a topic's size; it exceeds the exact count once
    messages have been deleted or compacted away.
    """
    return (
        topic_profile(envelope)
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("partitions"),
            F.sum("end_offset").alias("approximate_messages"),
            F.sum("messages").alias("messages"),
        )
    )


def topic_list(envelope: DataFrame) -> DataFrame:
    return envelope.select("topic").distinct()


def describe_topic(envelope: DataFrame, topic: str) -> DataFrame:
    """Totals of one topic as one row; a topic without messages has ``found`` false."""
    partitions = topic_profile(envelope.filter(F.col("topic") == topic))
    return partitions.agg(
        F.lit(topic).alias("topic"),
        (F.count(F.lit(1)) > 0).alias("found"),
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("end_offset"), F.lit(0)).alias("approximate_messages"),
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
    )


def end_offsets(spark: SparkSession, reported: str) -> DataFrame:
    """End offset per topic partition as a Kafka query reports it; no message is read for that.

    ``reported`` is ``query.lastProgress.sources[0].endOffset``. A query that starts at ``latest`` with
    the trigger ``AVAILABLE_NOW`` reports the ends of a topic at once, where ``topic_profile`` reads all of it.
    """
    offsets = F.from_json(F.lit(reported), "map<string, map<string, bigint>>")
    return (
        spark.range(0, 1, 1, 1)
        .select(F.explode(offsets).alias("topic", "partitions"))
        .select("topic", F.explode("partitions").alias("partition", "end_offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )
