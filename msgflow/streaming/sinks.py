"""Starting and finishing streaming writes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..parquet import PARQUET_OPTIONS

# Process what is there, then stop.
AVAILABLE_NOW = {"availableNow": True}


def every(interval: str) -> dict[str, str]:
    """Trigger at a fixed interval, as in ``every("30 seconds")``."""
    return {"processingTime": interval}


def parquet_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Appends rows to a Parquet folder, exactly once, and returns the running query.

    Without ``trigger`` the next batch starts when the last one ends. ``partition_by`` makes a folder
    per value: fit for columns with few values, such as a date, not for a key.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").options(**PARQUET_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.option("path", path).option("checkpointLocation", checkpoint).start()


def send(messages: DataFrame, options: Mapping[str, str], topic: str) -> None:
    """Produces the columns ``key`` and ``value`` of ``to_messages`` to a Kafka topic.

    ``options`` are those of ``kafka_options``; what concerns reading is left out.
    """
    connection = {name: value for name, value in options.items() if name.startswith("kafka.")}
    messages.write.format("kafka").options(**connection).option("topic", topic).save()


def run_batches(
    messages: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Calls ``write(batch, batch_id)`` for every micro-batch and returns the running query."""
    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def with_peek(write: Callable[[DataFrame, int], None], count: int = 2) -> Callable[[DataFrame, int], None]:
    """Wraps a batch writer: prints the schema and a few rows of each batch. For development only."""

    def shown(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.printSchema()
        batch.limit(count).show(truncate=False)
        write(batch, batch_id)

    return shown


def run_to_end(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Waits for an ``AVAILABLE_NOW`` query, however long it takes.

    With ``timeout`` a query that takes longer than so many seconds is stopped, and an error is raised.
    """
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query was not done after {timeout} s")
    return query
