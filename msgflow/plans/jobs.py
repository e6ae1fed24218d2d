"""End-to-end jobs: a source of envelopes, a parse policy, and a sink.

``messages`` is what ``kafka_stream`` or ``replay_stream`` returns. Each streaming job returns its
running query; wait with ``query.awaitTermination()`` and stop with ``query.stop()``. A batch that was
cut off runs again from the checkpoint at the next start.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.inference import sample_schema
from ..operators.policies import FALLBACK_EVENT, PRODUCT, fixed_schema_rows, lenient_records, strict_records
from ..parquet import PARQUET_OPTIONS
from ..sources.envelope import narrow_envelope, wide_envelope
from ..sources.files import literal_messages
from ..streaming.batches import ConvertedBatches, InferredBatches, SplitBatches, dead_letter_batch
from ..streaming.published import OutputLog
from ..streaming.sinks import every, parquet_stream, run_batches


def literal_users(spark: SparkSession, texts: Sequence[str], path: str) -> None:
    """Texts given in code, strict user records, one Parquet folder."""
    users = strict_records(literal_messages(spark, texts))
    users.write.options(**PARQUET_OPTIONS).mode("append").parquet(path)


def validated_users_stream(
    messages: DataFrame, path: str, checkpoint: str, *, trigger: Mapping | None = None
) -> StreamingQuery:
    """User records of valid messages, wrong types replaced by defaults, the rest skipped and counted."""
    users = lenient_records(wide_envelope(messages), counter="users")
    return parquet_stream(users, path, checkpoint, trigger=trigger or every("1 second"))


def product_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    schema: T.StructType = PRODUCT,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Every message as a row of a fixed schema."""
    rows = fixed_schema_rows(narrow_envelope(messages), schema)
    return parquet_stream(rows, path, checkpoint, trigger=trigger)


def product_stream_by_value(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str],
    schema: T.StructType = PRODUCT,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """``product_stream`` with a folder per value of ``partition_by``.

    Each batch is rebalanced by those columns first, so it writes a file per value instead of one per
    value and task; a value with many rows is spread over several tasks. Choose a column with few
    values, and ``compact(..., partition_by=...)`` to merge the files of many batches.
    """
    rows = fixed_schema_rows(narrow_envelope(messages), schema).hint("rebalance", *partition_by)
    return parquet_stream(rows, path, checkpoint, partition_by=partition_by, trigger=trigger or every("30 seconds"))


def sampled_schema_stream(
    messages: DataFrame, sample: DataFrame, path: str, checkpoint: str, *, trigger: Mapping | None = None
) -> StreamingQuery:
    """Fixed schema taken from the first JSON object of ``sample``.

    ``sample`` is a bounded read of replayed messages; for a Kafka topic pass a stream of it that is bounded by
    ``max_offsets_per_trigger``, of which only the first batches are read (see ``first_document_of_stream``).
    """
    schema = sample_schema(wide_envelope(sample), f"{checkpoint}.sample")
    return product_stream(messages, path, checkpoint, schema=schema, trigger=trigger)


def split_stream(
    messages: DataFrame,
    good_path: str,
    bad_path: str,
    checkpoint: str,
    *,
    schema: T.StructType = FALLBACK_EVENT,
    trigger: Mapping | None = None,
    log: OutputLog | None = None,
) -> StreamingQuery:
    """Messages that fit a schema to one folder, all others to a second one; with a log, both sides of a batch at once."""
    write = SplitBatches(schema, good_path, bad_path, log=log)
    return run_batches(narrow_envelope(messages), write, checkpoint, trigger=trigger)


def per_batch_schema_stream(
    messages: DataFrame,
    path: str,
    error_path: str,
    checkpoint: str,
    *,
    accumulate: bool = True,
    trigger: Mapping | None = None,
    log: OutputLog | None = None,
) -> StreamingQuery:
    """Schema inferred from every batch, rows next to their envelope; a batch whose data fail goes to ``error_path``."""
    write = dead_letter_batch(InferredBatches(path, accumulate=accumulate, log=log), error_path)
    return run_batches(wide_envelope(messages), write, checkpoint, trigger=trigger)


def recursive_schema_stream(
    messages: DataFrame,
    path: str,
    bad_path: str,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    log: OutputLog | None = None,
) -> StreamingQuery:
    """Schema per batch with nested objects and timestamps; texts that are no object to ``bad_path``.

    Bound the batches at the source: ``maxOffsetsPerTrigger`` for Kafka, files per trigger for replay.
    """
    write = ConvertedBatches(path, bad_path, log=log)
    return run_batches(wide_envelope(messages), write, checkpoint, trigger=trigger or every("1 second"))
