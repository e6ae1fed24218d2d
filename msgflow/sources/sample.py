"""One message of a topic, found with as little of the topic as its source allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import MALFORMED, open_document


def first_document(wide: DataFrame, window: int = 10_000) -> str | None:
    """Text of the first JSON object by partition and offset, or None if there is none.

    Works on a bounded wide envelope. In Parquet the lowest coordinates come from two integer columns; the
    look-up then touches one range of offsets only, which the scan can skip to. If that range holds
    no object, the ordered look-up runs over all messages. A Kafka scan can skip nothing and would read the topic
    each time: take ``first_document_of_stream`` there.
    """
    start = wide.agg(F.min(F.struct("kafka_partition", "kafka_offset")).alias("at")).first()["at"]
    if start is None:
        return None
    partition, offset = start
    near = (F.col("kafka_partition") == partition) & F.col("kafka_offset").between(offset, offset + window)
    for candidates in (wide.filter(near), wide):
        document = open_document(F.col("json_string"), [])
        found = (
            candidates.filter(document.getField(MALFORMED).isNull())
            .filter(F.trim("json_string") != "")
            .orderBy("kafka_partition", "kafka_offset")
            .select("json_string")
            .limit(1)
            .first()
        )
        if found is not None:
            return found["json_string"]
    return None


def first_document_of_stream(wide: DataFrame, checkpoint: str) -> str | None:
    """Text of the first JSON object in a streaming wide envelope, read in bounded micro-batches from the start.

    The bound is the source's own: ``max_offsets_per_trigger`` of ``kafka_options``, or files per trigger of a replay. Batches
    are taken one after the other until one holds an object, so most topics cost one small batch. Within a batch the
    first one by partition and offset counts. The checkpoint is needed for this look-up only.
    """
    found: list[str] = []

    def look(batch: DataFrame, batch_id: int) -> None:
        # Batches are lazy: those after the first find are not read.
        if not found and (text := first_document(batch)) is not None:
            found.append(text)

    query = wide.writeStream.foreachBatch(look).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    while not found and not query.awaitTermination(1):
        pass
    query.stop()
    return found[0] if found else None
