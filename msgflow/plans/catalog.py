"""The registered queries: each runs one operator, or one whole job, over the base tables.

Every function takes (spark, sf_dir) and returns a DataFrame. Timestamps are returned without a zone,
nested fields are flattened, so that results compare column by column with another engine's.
"""

from __future__ import annotations

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_utc_timestamp, base64_text, is_iso_timestamp, is_utf8, utf8_text
from ..operators import (
    FALLBACK_EVENT,
    PRODUCT,
    USER,
    array_rows,
    bad_rows,
    batch_schema,
    bounded_request_batches,
    captured_rows,
    clustered,
    compact,
    converted_rows,
    describe_topic,
    fixed_schema_rows,
    good_rows,
    inferred_rows,
    item_json_bytes,
    lenient_records,
    merged_sample,
    merged_sketches,
    merged_summaries,
    message_sample,
    offset_account,
    offset_gaps,
    parse_with_capture,
    recursive_schema,
    rejected_rows,
    request_batches,
    request_bodies,
    room_for_items,
    sample_schema,
    schema_of_sample,
    score_requests,
    sketched_figures,
    split_counts,
    strict_records,
    summarized_schema,
    topic_list,
    topic_profile,
    topic_sketches,
    topic_totals,
)
from ..parquet import PARQUET_OPTIONS, legacy_layout
from ..session import work_folder
from ..sources import (
    bytes_per_batch,
    first_document,
    narrow_envelope,
    replay_batch,
    replay_stream,
    to_messages,
    wide_envelope,
)
from ..sources.envelope import to_envelope
from ..sources.envelope import ENVELOPE, ORIGIN
from ..operators.samples import SAMPLE
from ..operators.sketches import SKETCHES
from ..streaming import (
    AVAILABLE_NOW,
    ConvertedBatches,
    CounterListener,
    InferredBatches,
    KeptTable,
    OffsetAccounts,
    OutputLog,
    SplitBatches,
    VariantBatches,
    compact_published,
    dead_letter_batch,
    every,
    grouped_messages,
    parquet_stream,
    profile_stream,
    read_account,
    read_batches,
    read_kept,
    read_versions,
    run_batches,
    run_to_end,
    variant_field,
)
from ..streaming.account import PROFILE
from .corpus import (
    COERCION_VALUE,
    EDGE_VALUE,
    EVENT_VALUE,
    ONE_BAD_PARTITION_VALUE,
    TIMESTAMP_TEXT,
    USER_VALUE,
    WIDENED_VALUE,
    damaged_topic,
    event_messages,
    product_messages,
    store_messages,
    table,
    transaction_texts,
)
from .jobs import (
    product_stream,
    product_stream_by_value,
    recursive_schema_stream,
    sampled_schema_stream,
    split_stream,
    validated_users_stream,
)

AT = ("kafka_partition", "kafka_offset")
SYSTEM = "You describe documents."
PROMPT = 'What is "new" here?'
IMAGES_PER_REQUEST = 3
# The scorer of the registered query refuses bodies whose size is divisible by this.
REFUSED = 5
# Staged topics come in so many batches or more.
LEAST_BATCHES = 4
# Bounds of a request body, and of a group of messages.
BODY_BYTES = 40_000
GROUP_MESSAGES, GROUP_IDLE = 20, "2 hours"
SAMPLE_MESSAGES = 100
# What the estimates of the registered query keep to: three standard errors of the keys, and the ranks of the sizes.
KEYS_ERROR, RANK_ERROR = 0.05, 0.02


def _plain(rows: DataFrame) -> DataFrame:
    """Timestamps as local date and time, without a zone."""
    zoned = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_envelope(event_messages(spark, sf_dir))


def _staged(messages: DataFrame, purpose: str) -> str:
    """Messages as a replay directory: every task writes its messages in four files, by a remainder of the offset."""
    path = work_folder(messages.sparkSession, purpose)
    parts = messages.withColumn("arrival", F.col("offset") % 4)
    parts.write.options(**PARQUET_OPTIONS).partitionBy("arrival").parquet(path)
    return path


def replayed(spark: SparkSession, path: str, batches: int = LEAST_BATCHES) -> DataFrame:
    """A staged topic as a stream in batches of bounded bytes: a share of the topic each, and a split a core at most."""
    return replay_stream(spark, path, bytes_per_trigger=bytes_per_batch(spark, path, batches))


# Envelopes and messages


def envelope_wide(spark, sf_dir):
    return _plain(_users(spark, sf_dir))


def envelope_narrow(spark, sf_dir):
    return _plain(narrow_envelope(event_messages(spark, sf_dir)))


def produce_messages(spark, sf_dir):
    """Rows as key and JSON value, written as a replayable envelope, replayed and parsed again."""
    customers = table(spark, sf_dir, "customer")
    sent = to_messages(customers, F.col("c_custkey"))
    envelope = to_envelope(
        sent,
        key=F.col("key"),
        value=F.col("value"),
        topic=F.lit("customers"),
        partition=F.lit(0),
        offset=F.col("key").cast("bigint"),
        timestamp=F.lit("2024-03-22 14:35:00"),
    )
    messages = wide_envelope(replay_batch(spark, _staged(envelope, "customers")))
    return fixed_schema_rows(messages.withColumnRenamed("message_key", "key"), customers.schema, keep=("key",))


def utf8_check(spark, sf_dir):
    """Payload bytes, every tenth not valid UTF-8, as text."""
    data = F.expr("CASE WHEN event_id % 10 = 3 THEN X'FF7B' ELSE CAST(event_type AS BINARY) END")
    rows = table(spark, sf_dir, "events").select("event_id", data.alias("data"))
    return rows.select("event_id", utf8_text(F.col("data")).alias("text"), is_utf8(F.col("data")).alias("valid"))


# Parse policies


def strict_coerce(spark, sf_dir):
    messages = wide_envelope(event_messages(spark, sf_dir, COERCION_VALUE))
    return strict_records(messages, keep=AT)


def lenient_validate(spark, sf_dir):
    return lenient_records(_users(spark, sf_dir), keep=AT)


def fixed_permissive(spark, sf_dir):
    return fixed_schema_rows(_users(spark, sf_dir), USER, keep=AT)


def fixed_products(spark, sf_dir):
    return fixed_schema_rows(wide_envelope(product_messages(spark, sf_dir)), PRODUCT, keep=("message_key",))


def _split(spark, sf_dir):
    return parse_with_capture(narrow_envelope(event_messages(spark, sf_dir)), USER)


def split_good(spark, sf_dir):
    return _plain(good_rows(_split(spark, sf_dir)))


def split_bad(spark, sf_dir):
    return _flat_bad(bad_rows(_split(spark, sf_dir)))


def _flat_bad(bad: DataFrame) -> DataFrame:
    return _plain(bad.select("message_key", "json_string", "kafka_timestamp", "parsed_data.*", "corrupt_record"))


def split_counts_query(spark, sf_dir):
    return split_counts(_split(spark, sf_dir))


def fallback_events(spark, sf_dir):
    messages = narrow_envelope(event_messages(spark, sf_dir, EVENT_VALUE))
    return _plain(good_rows(parse_with_capture(messages, FALLBACK_EVENT)))


def sample_inferred(spark, sf_dir):
    messages = _users(spark, sf_dir)
    return fixed_schema_rows(messages, sample_schema(messages), keep=AT)


def sample_fallback(spark, sf_dir):
    """Prose as messages: no sample can be parsed, so the default schema applies."""
    documents = table(spark, sf_dir, "documents")
    messages = documents.select(
        F.col("doc_id").alias("kafka_offset"), F.lit(0).alias("kafka_partition"), F.col("text").alias("json_string")
    )
    return fixed_schema_rows(messages, sample_schema(messages), keep=("kafka_offset",))


def batch_inferred(spark, sf_dir):
    messages = _users(spark, sf_dir)
    return _flat_specs(inferred_rows(messages, batch_schema(messages)))


def _flat_specs(rows: DataFrame) -> DataFrame:
    flat = rows.select("*", F.col("specs.v").alias("specs_v"), F.col("specs.at").alias("specs_at"))
    return _plain(flat.drop("specs"))


def array_rows_query(spark, sf_dir):
    schema = T.StructType([T.StructField(name, T.StringType()) for name in USER.names])
    return array_rows(_users(spark, sf_dir), schema, keep=AT)


def corrupt_capture(spark, sf_dir):
    return captured_rows(_users(spark, sf_dir), USER, keep=AT)


def recursive_infer(spark, sf_dir):
    messages = _users(spark, sf_dir)
    return _flat_specs(converted_rows(messages, recursive_schema(messages), keep=AT))


def recursive_rejected(spark, sf_dir):
    messages = _users(spark, sf_dir)
    return rejected_rows(messages, recursive_schema(messages), keep=AT)


def transaction_items(spark, sf_dir):
    """Nested sales messages under their inferred schema, one row per item."""
    messages = _sales(spark, sf_dir)
    sales = converted_rows(messages, recursive_schema(messages))
    items = sales.select("transaction_id", "store_id", "timestamp", "payment_method", F.inline("items"))
    return _plain(items)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of the sales, stored once for the passes that inference and conversion make over them."""
    path = work_folder(spark, "sales")
    transaction_texts(spark, sf_dir).select("json_string").write.options(**PARQUET_OPTIONS).parquet(path)
    return spark.read.parquet(path)


def empty_arrays(spark, sf_dir):
    """Every message has a row with its coordinates: arrays without elements and blank texts as well."""
    messages = wide_envelope(event_messages(spark, sf_dir, EDGE_VALUE))
    return inferred_rows(messages, batch_schema(messages), keep=AT).select(*AT, "id", "age", "_corrupt_record")


def blank_texts(spark, sf_dir):
    return captured_rows(wide_envelope(event_messages(spark, sf_dir, EDGE_VALUE)), USER, keep=AT)


def empty_objects(spark, sf_dir):
    """Messages without any field at all: none fits, so each is rejected with its text."""
    messages = wide_envelope(event_messages(spark, sf_dir, "'{}'"))
    schema = recursive_schema(messages)
    return converted_rows(messages, schema, keep=AT).join(
        rejected_rows(messages, schema, keep=AT), list(AT), "full_outer"
    )


def repeated_keys(spark, sf_dir):
    """Records with a key repeated inside a field, which keeps the last one."""
    return lenient_records(wide_envelope(event_messages(spark, sf_dir, EDGE_VALUE)), keep=AT)


# Inference and conversion


def _as_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    rows = [(name, data_type.simpleString()) for name, data_type in _paths(schema)]
    return spark.createDataFrame(rows, "field string, type string")


def _paths(schema: T.StructType, prefix: str = ""):
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            yield from _paths(field.dataType, f"{prefix}{field.name}.")
        else:
            yield f"{prefix}{field.name}", field.dataType


def sampled_schema_fields(spark, sf_dir):
    """Fields of the schema of one message: the first JSON object of the topic."""
    return _as_rows(spark, schema_of_sample(spark, first_document(_users(spark, sf_dir))))


def batch_schema_fields(spark, sf_dir):
    return _as_rows(spark, batch_schema(_users(spark, sf_dir)))


def recursive_schema_fields(spark, sf_dir):
    return _as_rows(spark, recursive_schema(_users(spark, sf_dir)))


def timestamp_detect(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", F.expr(TIMESTAMP_TEXT).alias("text"))
    value = as_utc_timestamp(F.col("text")).alias("value")
    return _plain(texts.select("event_id", "text", value, is_iso_timestamp(F.col("text")).alias("is_timestamp")))


# Streams


def stream_file_sink(spark, sf_dir):
    path, out = _staged(product_messages(spark, sf_dir), "products"), work_folder(spark, "product-rows")
    run_to_end(product_stream(replayed(spark, path), f"{out}/data", f"{out}/checkpoint", trigger=AVAILABLE_NOW))
    return spark.read.parquet(f"{out}/data")


def stream_lenient(spark, sf_dir):
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "user-rows")
    messages = replayed(spark, path)
    run_to_end(validated_users_stream(messages, f"{out}/data", f"{out}/checkpoint", trigger=AVAILABLE_NOW))
    return spark.read.parquet(f"{out}/data")


def stream_partitioned(spark, sf_dir):
    path, out = _staged(store_messages(spark, sf_dir), "stores"), work_folder(spark, "store-rows")
    messages = replayed(spark, path)
    run_to_end(product_stream_by_value(
            messages, f"{out}/data", f"{out}/checkpoint", partition_by=["id"], trigger=AVAILABLE_NOW
        ))
    return spark.read.parquet(f"{out}/data")


def stream_interval(spark, sf_dir):
    """The partitioned sink at a fixed interval: it runs until it has caught up, and is stopped."""
    path, out = _staged(store_messages(spark, sf_dir), "stores"), work_folder(spark, "interval-rows")
    query = product_stream_by_value(
        replayed(spark, path), f"{out}/data", f"{out}/checkpoint", partition_by=["id"], trigger=every("1 second")
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.parquet(f"{out}/data")


def stream_sampled(spark, sf_dir):
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "sampled-rows")
    sample, messages = replay_batch(spark, path), replayed(spark, path)
    run_to_end(sampled_schema_stream(messages, sample, f"{out}/data", f"{out}/checkpoint", trigger=AVAILABLE_NOW))
    return spark.read.parquet(f"{out}/data")


def _run_split(spark, sf_dir):
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "split-rows")
    messages = replayed(spark, path)
    run_to_end(
        split_stream(
            messages, f"{out}/good", f"{out}/bad", f"{out}/checkpoint", schema=USER, trigger=AVAILABLE_NOW
        )
    )
    return out


def stream_split_good(spark, sf_dir):
    return _plain(read_batches(spark, f"{_run_split(spark, sf_dir)}/good"))


def stream_split_bad(spark, sf_dir):
    return _flat_bad(read_batches(spark, f"{_run_split(spark, sf_dir)}/bad"))


def _run_by_partition(spark, sf_dir, run, parts, value=USER_VALUE):
    """Feeds the topic partition by partition, restarting the query for each, so schemas drift."""
    source = work_folder(spark, "drifting")
    messages = replay_batch(spark, _staged(event_messages(spark, sf_dir, value), "users"))
    for part in parts:
        arrived = messages.filter(F.col("partition").isin(*part)).select(*ENVELOPE.names)
        arrived.write.mode("append").options(**PARQUET_OPTIONS).parquet(source)
        run(source)


def stream_batch_inferred(spark, sf_dir):
    """Four batches whose schemas differ, read back under the widest one."""
    out = work_folder(spark, "inferred-rows")

    def run(source):
        write = dead_letter_batch(InferredBatches(f"{out}/data"), f"{out}/errors")
        messages = wide_envelope(replayed(spark, source, 1))
        run_to_end(run_batches(messages, write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    _run_by_partition(spark, sf_dir, run, [(0,), (1,), (2,), (3,)])
    return _flat_specs(read_versions(spark, f"{out}/data"))


def stream_dead_letter(spark, sf_dir):
    """The strict policy on batches: the one with broken messages is kept whole, as it came."""
    out = work_folder(spark, "strict-rows")

    def write_strict(batch, batch_id):
        strict_records(batch, keep=AT).write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    def run(source):
        write = dead_letter_batch(write_strict, f"{out}/errors")
        messages = wide_envelope(replayed(spark, source, 1))
        run_to_end(run_batches(messages, write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    _run_by_partition(spark, sf_dir, run, [(0, 1, 2), (3,)], ONE_BAD_PARTITION_VALUE)
    written = read_batches(spark, f"{out}/data").select(*AT, F.lit(False).alias("failed"))
    failed = read_batches(spark, f"{out}/errors").select(*AT, F.lit(True).alias("failed"))
    return written.unionByName(failed)


def stream_checkpoint_reset(spark, sf_dir):
    """The same topic split twice into the same folders, the second time with a new checkpoint: both runs are there."""
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "reset-rows")
    for number in range(2):
        checkpoint = f"{out}/checkpoint-{number}"
        run_to_end(
            split_stream(
                replayed(spark, path), f"{out}/good", f"{out}/bad", checkpoint, schema=USER, trigger=AVAILABLE_NOW
            )
        )
    rows = read_batches(spark, f"{out}/good").select("message_key", "id", "name", "age")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def stream_replayed_failure(spark, sf_dir):
    """A batch fails and is kept as a dead letter; the query breaks off, and the replay of the batch succeeds."""
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "replayed-rows")
    attempts = []

    class FailsOnce(SplitBatches):
        def process(self, batch, batch_id):
            counts = super().process(batch, batch_id)
            if batch_id == 1 and not attempts:
                raise RuntimeError("the first attempt fails after it has written")
            return counts

    write = dead_letter_batch(FailsOnce(USER, f"{out}/good", f"{out}/bad"), f"{out}/errors")

    def breaks_off(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not attempts:
            attempts.append(batch_id)
            raise RuntimeError("the driver stops before the batch is committed")

    for _ in range(2):
        query = run_batches(
            narrow_envelope(replayed(spark, path)).withColumn("kafka_offset", F.lit(0)),
            breaks_off,
            f"{out}/checkpoint",
            trigger=AVAILABLE_NOW,
        )
        try:
            run_to_end(query)
        except StreamingQueryException:
            continue
    good = read_batches(spark, f"{out}/good").select(F.lit("good").alias("side"))
    bad = read_batches(spark, f"{out}/bad").select(F.lit("bad").alias("side"))
    return good.unionByName(bad).groupBy("side").agg(F.count(F.lit(1)).alias("messages"))


def snapshots(spark, sf_dir):
    """What readers of a split topic see: while each batch is between its sides, after it, and when the last one has run again.

    All but the moments in flight are read at the end, from the versions of the log.
    """
    out = work_folder(spark, "published")
    log, good, bad = OutputLog(f"{out}/log"), f"{out}/good", f"{out}/bad"
    seen, again = [], []

    def counts(version):
        sides = [log.files(spark, version).where(F.col("side") == side).count() for side in (good, bad)]
        return [log.read(spark, side, version).count() if n else 0 for side, n in zip((good, bad), sides, strict=True)]

    class Watched(SplitBatches):
        def put(self, rows, side, batch_id, folder=None):
            super().put(rows, side, batch_id, folder)
            if side == good:
                seen.append(("in flight", log.latest(spark), *counts(log.latest(spark))))

    write = Watched(USER, good, bad, log=log)

    def breaks_off(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 3 and not again:
            again.append(batch_id)
            raise RuntimeError("the driver stops before the batch is committed")

    def run(source):
        for _ in range(2):
            messages = narrow_envelope(replayed(spark, source, 1))
            query = run_batches(messages, breaks_off, f"{out}/checkpoint", trigger=AVAILABLE_NOW)
            try:
                run_to_end(query)
            except StreamingQueryException:
                continue
            break

    _run_by_partition(spark, sf_dir, run, [(0,), (1,), (2,), (3,)])
    seen += [("published", version, *counts(version)) for version in range(log.latest(spark) + 1)]
    return spark.createDataFrame(seen, "moment string, version bigint, good bigint, bad bigint")


def transient_failure(spark, sf_dir):
    """One batch meets a full disk and runs again, another holds data that the strict policy refuses: a dead letter."""
    out = work_folder(spark, "transient")
    log, data, errors = OutputLog(f"{out}/log"), f"{out}/data", f"{out}/errors"
    failed = []

    class Strict(SplitBatches):
        def sides(self):
            return [data]

        def process(self, batch, batch_id):
            self.put(strict_records(batch, keep=AT), data, batch_id)
            if batch_id == 1 and not failed:
                failed.append(batch_id)
                raise OSError("no space left on device")
            return {"seen": 1}

    write = dead_letter_batch(Strict(USER, data, data, log=log), errors)

    def run(source):
        for _ in range(2):
            query = run_batches(wide_envelope(replayed(spark, source, 1)), write, f"{out}/checkpoint", trigger=AVAILABLE_NOW)
            try:
                run_to_end(query)
            except StreamingQueryException:
                continue
            break

    _run_by_partition(spark, sf_dir, run, [(0,), (1, 2), (3,)], ONE_BAD_PARTITION_VALUE)
    written = log.read(spark, data).select(*AT, F.lit(False).alias("failed"))
    dead = log.read(spark, errors).select(*AT, F.lit(True).alias("failed"))
    return written.unionByName(dead).withColumn("attempts", F.lit(1 + len(failed)))


def stream_widened(spark, sf_dir):
    """A timestamp field that becomes text, and large integers that meet a fraction, read back exactly as text."""
    out = work_folder(spark, "widened-rows")

    def run(source):
        write = ConvertedBatches(f"{out}/data", f"{out}/bad", keep=AT)
        messages = wide_envelope(replayed(spark, source, 1))
        run_to_end(run_batches(messages, write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    _run_by_partition(spark, sf_dir, run, [(0, 1), (2,), (3,)], WIDENED_VALUE)
    return read_versions(spark, f"{out}/data", exact=True).select(*AT, "at", "n")


def stream_variants(spark, sf_dir):
    """The same topic stored as variants: one folder, every value as it was written, typed by the reader."""
    out = work_folder(spark, "variants")
    log = OutputLog(f"{out}/log")

    def run(source):
        write = VariantBatches(f"{out}/data", keep=AT, log=log)
        run_to_end(run_batches(wide_envelope(replayed(spark, source, 1)), write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    _run_by_partition(spark, sf_dir, run, [(0, 1), (2,), (3,)], WIDENED_VALUE)
    rows = log.read(spark, f"{out}/data")
    return rows.select(
        *AT,
        variant_field("at").alias("at"),
        variant_field("n").alias("n"),
        variant_field("n", "bigint").alias("whole"),
        variant_field("n", "double").alias("number"),
    )


def variant_users(spark, sf_dir):
    """User messages of all kinds as variants: their fields by path, and the texts that are no JSON."""
    out = work_folder(spark, "variant-users")
    VariantBatches(out, keep=AT)(_users(spark, sf_dir), 0)
    rows = read_batches(spark, out)
    return rows.select(*AT, variant_field("name").alias("name"), variant_field("specs.v", "double").alias("specs_v"), "_corrupt_record")


def batch_counters(spark, sf_dir):
    """What the batch writers report over a topic: messages seen, rows kept and rejected."""
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "counted-batches")
    totals = []
    for name, kind in (("inferred", InferredBatches), ("converted", ConvertedBatches)):
        sums = dict.fromkeys(("seen", "kept", "rejected"), 0)

        def report(batch_id, counts, sums=sums):
            for column in sums:
                sums[column] += counts[column]

        write = kind(f"{out}/{name}", report=report)
        messages = wide_envelope(replayed(spark, path))
        run_to_end(run_batches(messages, write, f"{out}/{name}-checkpoint", trigger=AVAILABLE_NOW))
        totals.append((name, *sums.values()))
    return spark.createDataFrame(totals, "writer string, seen bigint, kept bigint, rejected bigint")


def stream_recursive(spark, sf_dir):
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "recursive-rows")
    messages = replayed(spark, path)
    run_to_end(
        recursive_schema_stream(messages, f"{out}/data", f"{out}/bad", f"{out}/checkpoint", trigger=AVAILABLE_NOW)
    )
    return _flat_specs(read_versions(spark, f"{out}/data"))


def stream_rejected(spark, sf_dir):
    """What the recursive policy cannot use, from its dead-letter folder."""
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "rejected-rows")
    write = ConvertedBatches(f"{out}/data", f"{out}/bad")
    messages = wide_envelope(replayed(spark, path))
    run_to_end(run_batches(messages, write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))
    return _plain(read_batches(spark, f"{out}/bad").select(*ORIGIN, "json_string"))


def stream_restart(spark, sf_dir):
    """Half the topic, a restart without news, the other half: every message counts once."""
    out = work_folder(spark, "restarted-rows")

    def run(source):
        rows = lenient_records(wide_envelope(replayed(spark, source, 1)), keep=AT)
        for _ in range(2):
            run_to_end(parquet_stream(rows, f"{out}/data", f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    _run_by_partition(spark, sf_dir, run, [(0, 1), (2, 3)])
    rows = spark.read.parquet(f"{out}/data")
    return rows.groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("kafka_offset").alias("distinct_messages")
    )


def stream_counters(spark, sf_dir):
    """The counts a running query reports: seen, kept and skipped messages."""
    path, out = _staged(event_messages(spark, sf_dir), "users"), work_folder(spark, "counted-rows")
    listener = CounterListener()
    spark.streams.addListener(listener)
    try:
        messages = replayed(spark, path)
        query = validated_users_stream(messages, f"{out}/data", f"{out}/checkpoint", trigger=AVAILABLE_NOW)
        counts = listener.wait_for(run_to_end(query).runId)["users"]
    finally:
        spark.streams.removeListener(listener)
    names = ("seen", "kept", "skipped")
    return spark.createDataFrame([tuple(counts[n] for n in names)], "seen bigint, kept bigint, skipped bigint")


def compacted(spark, sf_dir):
    out = work_folder(spark, "compacted")
    lenient_records(_users(spark, sf_dir), keep=AT).write.options(**PARQUET_OPTIONS).parquet(f"{out}/small")
    compact(spark, f"{out}/small", f"{out}/large")
    return spark.read.parquet(f"{out}/large")


def compacted_in_place(spark, sf_dir):
    """Published batches merged in place, a second time without news, and again after two more batches.

    Each row has what readers see after a step, and at the version before any merge.
    """
    out = work_folder(spark, "merged")
    log, good, bad = OutputLog(f"{out}/log"), f"{out}/good", f"{out}/bad"
    write = SplitBatches(USER, good, bad, log=log)
    messages = event_messages(spark, sf_dir)

    def arrive(*numbers):
        for number in numbers:
            write(narrow_envelope(messages.where(F.col("offset") % 6 == number)), number)

    arrive(0, 1, 2, 3)
    before, steps = log.latest(spark), []

    def step(name):
        sizes = {r["path"]: r["bytes"] for r in log.files(spark).where(F.col("side") == good).collect()}
        done = compact_published(spark, log, good)
        gone = set(sizes) - set(log.paths(spark, good))
        exact = done.bytes_read == sum(sizes[path] for path in gone) and done.files_read == len(gone)
        rows, earlier = log.read(spark, good).count(), log.read(spark, good, before).count()
        steps.append((name, done.version is not None, exact, rows, earlier))

    step("first")
    step("again")
    arrive(4, 5)
    step("more")
    return spark.createDataFrame(steps, "step string, merged boolean, read_small_files_only boolean, n_rows bigint, rows_before bigint")


def schema_from_summaries(spark, sf_dir):
    """The schema of a folder from the summaries of its four batches alone, with the kinds of value on every path and their counts."""
    out = work_folder(spark, "summarized")
    log, summaries = OutputLog(f"{out}/log"), f"{out}/summaries"

    def run(source):
        write = ConvertedBatches(f"{out}/data", f"{out}/bad", log=log, summary_path=summaries)
        run_to_end(run_batches(wide_envelope(replayed(spark, source, 1)), write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    _run_by_partition(spark, sf_dir, run, [(0,), (1,), (2,), (3,)])
    summary = merged_summaries(log.read(spark, summaries))
    types = _as_rows(spark, summarized_schema(spark, summary))
    kind = F.when(F.col("kind").rlike("^(DECIMAL|DOUBLE)"), "FRACTION").otherwise(F.col("kind")).alias("kind")
    counts = summary.groupBy(F.array_join("path", ".").alias("field"), kind).agg(F.sum("messages").alias("messages"))
    return counts.join(types, "field", "left")


def legacy_sales(spark, sf_dir):
    """Nested sales written in the layout for old readers, read back item by item."""
    out = work_folder(spark, "legacy-sales")
    messages = _sales(spark, sf_dir)
    with legacy_layout(spark):
        converted_rows(messages, recursive_schema(messages)).write.options(**PARQUET_OPTIONS).parquet(out)
    return spark.read.parquet(out).select("transaction_id", F.inline("items"))


# Topic profile


def topic_profile_query(spark, sf_dir):
    return topic_profile(event_messages(spark, sf_dir))


def topic_totals_query(spark, sf_dir):
    return topic_totals(event_messages(spark, sf_dir))


def topic_list_query(spark, sf_dir):
    return topic_list(event_messages(spark, sf_dir))


def describe_topic_query(spark, sf_dir):
    messages = event_messages(spark, sf_dir)
    return describe_topic(messages, "purchase").unionByName(describe_topic(messages, "refund"))


def running_profile(spark, sf_dir):
    """The profile of a topic that arrives in four parts, the query started anew for each: what is kept after the last batch."""
    out = work_folder(spark, "profile")
    log = OutputLog(f"{out}/log")

    def run(source):
        messages = replayed(spark, source, 1)
        run_to_end(profile_stream(messages, f"{out}/profile", log, f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    _run_by_partition(spark, sf_dir, run, [(0, 1), (2,), (3,)])
    return read_kept(spark, f"{out}/profile", log, PROFILE)


def kept_sample(spark, sf_dir):
    """The messages with the least digests, kept from batch to batch of a staged topic."""
    path, out = _staged(event_messages(spark, sf_dir), "sampled"), work_folder(spark, "sample")
    log = OutputLog(f"{out}/log")

    def update(known, batch):
        new = message_sample(batch, SAMPLE_MESSAGES)
        return merged_sample(new if known is None else known.unionByName(new), SAMPLE_MESSAGES)

    write = KeptTable(f"{out}/sample", log, SAMPLE, update)
    run_to_end(run_batches(wide_envelope(replayed(spark, path)), write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))
    return read_kept(spark, f"{out}/sample", log, SAMPLE)


def kept_sketches(spark, sf_dir):
    """Estimates from sketches that were merged batch by batch, and whether they keep to their bounds against the exact figures."""
    path, out = _staged(event_messages(spark, sf_dir), "sketched"), work_folder(spark, "sketches")
    log = OutputLog(f"{out}/log")

    def update(known, batch):
        new = topic_sketches(batch)
        return new if known is None else merged_sketches(known.unionByName(new))

    write = KeptTable(f"{out}/sketches", log, SKETCHES, update)
    run_to_end(run_batches(replayed(spark, path), write, f"{out}/checkpoint", trigger=AVAILABLE_NOW))
    figures = sketched_figures(read_kept(spark, f"{out}/sketches", log, SKETCHES), (0.5, 0.9))
    messages = event_messages(spark, sf_dir).select("topic", "key", F.octet_length("value").alias("size"))
    sized = messages.join(F.broadcast(figures), "topic")

    def close(i, share):
        below = F.count_if(F.col("size") < F.col("sizes")[i]) / F.count("size")
        upto = F.count_if(F.col("size") <= F.col("sizes")[i]) / F.count("size")
        return (below <= share + RANK_ERROR) & (upto >= share - RANK_ERROR)

    exact = F.count_distinct("key")
    return sized.groupBy("topic", F.col("messages")).agg(
        (F.abs(F.first("distinct_keys") - exact) <= KEYS_ERROR * exact).alias("keys_close"),
        close(0, 0.5).alias("median_close"),
        close(1, 0.9).alias("tenth_close"),
    )


def clustered_users(spark, sf_dir):
    """Records written along a curve through two columns, read back."""
    out = work_folder(spark, "clustered")
    users = lenient_records(_users(spark, sf_dir), keep=AT)
    clustered(users, ["id", "age"]).write.options(**PARQUET_OPTIONS).parquet(out)
    return spark.read.parquet(out)


def offset_gaps_query(spark, sf_dir):
    """Lost and repeated ranges of offsets of a damaged topic."""
    return offset_gaps(offset_account(damaged_topic(spark, sf_dir)))


def offset_account_stream(spark, sf_dir):
    """The whole account of the same topic, kept from batch to batch; one batch is published and then runs again.

    Any failure but that planned one is raised, since what is kept then is the account of a part of the topic.
    """
    path, out = _staged(damaged_topic(spark, sf_dir), "damaged"), work_folder(spark, "account")
    log = OutputLog(f"{out}/log")
    write = OffsetAccounts(f"{out}/account", log)
    broken = []

    def breaks_off(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            raise RuntimeError("the driver stops before the batch is committed")

    def run():
        run_to_end(run_batches(replayed(spark, path), breaks_off, f"{out}/checkpoint", trigger=AVAILABLE_NOW))

    try:
        run()
    except StreamingQueryException:
        if not broken:
            raise
        run()
    return read_account(spark, f"{out}/account", log)


def count_or_idle(spark, sf_dir):
    """Closed groups of each topic partition; the topic arrives in four parts, and the query is started anew for each."""
    out, source = work_folder(spark, "groups"), work_folder(spark, "in-order")
    messages = event_messages(spark, sf_dir)
    first, last = messages.agg(F.min("offset"), F.max("offset")).first()
    for quarter in range(4):
        part = F.floor((F.col("offset") - first) * 4 / (last - first + 1)) == quarter
        messages.where(part).write.mode("append").options(**PARQUET_OPTIONS).parquet(source)
        wide = wide_envelope(replayed(spark, source, 1))
        groups = grouped_messages(wide, size=GROUP_MESSAGES, idle=GROUP_IDLE)
        run_to_end(parquet_stream(groups, f"{out}/data", f"{out}/checkpoint", trigger=AVAILABLE_NOW))
    return spark.read.parquet(f"{out}/data")


# Requests


def base64_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", base64_text(F.encode("text", "UTF-8")).alias("content"))


def _batches(spark, sf_dir):
    return request_batches(
        table(spark, sf_dir, "documents"),
        group="source",
        order="doc_id",
        size=IMAGES_PER_REQUEST,
        content=base64_text(F.encode("text", "UTF-8")),
    )


def _bodies(spark, sf_dir):
    return request_bodies(_batches(spark, sf_dir), system=SYSTEM, prompt=PROMPT, domain="Text", model="describer")


def request_batches_query(spark, sf_dir):
    item_ids = F.transform("items", lambda item: item["position"].cast("string"))
    return _batches(spark, sf_dir).select(
        "source",
        "request_no",
        F.size("items").alias("n_items"),
        F.array_join(item_ids, ",").alias("item_ids"),
    )


def hot_group_requests(spark, sf_dir):
    """Requests where one group holds nine of ten documents, the others lie in small groups."""
    group = F.when(F.col("doc_id") % 10 > 0, F.lit("hot")).otherwise(F.col("source")).alias("owner")
    documents = table(spark, sf_dir, "documents").select(group, "doc_id", "text")
    batches = request_batches(documents, group="owner", order="doc_id", size=7, content=F.col("text"))
    return batches.select(
        "owner",
        "request_no",
        F.array_join(F.transform("items", lambda item: item["position"].cast("string")), ",").alias("item_ids"),
        F.md5(F.array_join("items.content", "|").cast("binary")).alias("contents_md5"),
    )


def byte_bounded_requests(spark, sf_dir):
    """Requests of at most seven items whose bodies have a bound in bytes, one group with nine of ten documents; an item that is larger is alone."""
    group = F.when(F.col("doc_id") % 10 > 0, F.lit("hot")).otherwise(F.col("source")).alias("owner")
    documents = table(spark, sf_dir, "documents").select(group, "doc_id", base64_text(F.encode("text", "UTF-8")).alias("content"))
    request = {"system": SYSTEM, "prompt": PROMPT, "domain": "Text", "model": "describer"}
    batches = bounded_request_batches(
        documents,
        group="owner",
        order="doc_id",
        max_items=7,
        max_bytes=room_for_items(spark, BODY_BYTES, **request),
        content=F.col("content"),
        item_bytes=item_json_bytes(F.col("content")),
    )
    return request_bodies(batches, **request).select(
        "owner",
        "request_no",
        F.array_join(F.transform("items", lambda item: item["position"].cast("string")), ",").alias("item_ids"),
        "items_bytes",
        F.col("body_bytes").cast("bigint").alias("body_bytes"),
        F.md5(F.encode("body", "UTF-8")).alias("body_md5"),
    )


def request_bodies_query(spark, sf_dir):
    """Fields read back from each body, its size and its fingerprint."""
    body = F.col("body")

    def field(path):
        return F.get_json_object(body, path)

    return _bodies(spark, sf_dir).select(
        "source",
        "request_no",
        field("$.modelName").alias("model"),
        field("$.modelPayload.max_tokens").cast("int").alias("max_tokens"),
        field("$.modelPayload.messages[0].role").alias("first_role"),
        field("$.modelPayload.messages[1].content[0].image").alias("first_image"),
        "body_bytes",
        F.md5(F.encode(body, "UTF-8")).alias("body_md5"),
    )


def score_requests_query(spark, sf_dir):
    """A local scorer that refuses some of the bodies, as a service would."""
    refused = REFUSED

    def size_scorer(bodies):
        sizes = bodies.str.encode("utf-8").str.len()
        status = (sizes % refused > 0).map({True: 200, False: 413})
        return pd.DataFrame({"status": status, "response": "bytes=" + sizes.astype(str)})

    return score_requests(_bodies(spark, sf_dir).select("source", "request_no", "body"), size_scorer)


# One name per operator; the prefix is its id in the operator inventory.
QUERIES = {
    "prj1_envelope_wide": envelope_wide,
    "prj2_envelope_narrow": envelope_narrow,
    "snk10_produce_messages": produce_messages,
    "str1_utf8_check": utf8_check,
    "prs1_strict_coerce": strict_coerce,
    "prs2_lenient_validate": lenient_validate,
    "prs3_fixed_permissive": fixed_permissive,
    "prs3_fixed_products": fixed_products,
    "prs4_split_good": split_good,
    "prs4_split_bad": split_bad,
    "prs4_fallback_events": fallback_events,
    "agg1_split_counts": split_counts_query,
    "prs5_sample_inferred": sample_inferred,
    "inf6_sample_fallback": sample_fallback,
    "prs6_batch_inferred": batch_inferred,
    "prs7_recursive_infer": recursive_infer,
    "prs7_rejected_rows": recursive_rejected,
    "prs7_transaction_items": transaction_items,
    "prs8_array_rows": array_rows_query,
    "prs8_empty_array": empty_arrays,
    "prs9_corrupt_capture": corrupt_capture,
    "prs9_blank_text": blank_texts,
    "prs7_empty_objects": empty_objects,
    "prs2_repeated_keys": repeated_keys,
    "inf1_sample_schema": sampled_schema_fields,
    "inf2_batch_schema": batch_schema_fields,
    "inf3_recursive_schema": recursive_schema_fields,
    "cst4_timestamp_detect": timestamp_detect,
    "snk1_stream_file_sink": stream_file_sink,
    "snk2_stream_partitioned": stream_partitioned,
    "stm2_stream_interval": stream_interval,
    "snk3_stream_lenient": stream_lenient,
    "src10_stream_sampled": stream_sampled,
    "snk4_stream_split_good": stream_split_good,
    "snk5_stream_split_bad": stream_split_bad,
    "snk4_checkpoint_reset": stream_checkpoint_reset,
    "stm5_stream_batch_inferred": stream_batch_inferred,
    "stm5_widened_columns": stream_widened,
    "snk7_stream_variants": stream_variants,
    "prs6_variant_users": variant_users,
    "snk6_stream_dead_letter": stream_dead_letter,
    "snk6_replayed_failure": stream_replayed_failure,
    "snk4_snapshot": snapshots,
    "snk6_transient_failure": transient_failure,
    "stm6_stream_recursive": stream_recursive,
    "flt4_stream_rejected": stream_rejected,
    "stm4_stream_restart": stream_restart,
    "stm6_count_or_idle": count_or_idle,
    "obs1_stream_counters": stream_counters,
    "obs1_batch_counters": batch_counters,
    "snk8_legacy_layout": legacy_sales,
    "snk9_compacted": compacted,
    "snk9_second_run": compacted_in_place,
    "inf2_from_summaries": schema_from_summaries,
    "agg3_topic_profile": topic_profile_query,
    "agg3_running_profile": running_profile,
    "src10_kept_sample": kept_sample,
    "obs1_kept_sketches": kept_sketches,
    "snk2_clustered": clustered_users,
    "agg3_offset_gaps": offset_gaps_query,
    "agg3_offset_account": offset_account_stream,
    "agg4_topic_totals": topic_totals_query,
    "agg5_topic_list": topic_list_query,
    "flt7_describe_topic": describe_topic_query,
    "str2_base64_documents": base64_documents,
    "req1_request_batches": request_batches_query,
    "req1_hot_group": hot_group_requests,
    "req4_byte_bounded": byte_bounded_requests,
    "req3_request_bodies": request_bodies_query,
    "udf4_score_requests": score_requests_query,
}
