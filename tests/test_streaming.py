import glob

import pyarrow.parquet as pq
import pytest
from msgflow.operators import USER, compact, fixed_schema_rows, strict_records
from msgflow.parquet import legacy_layout
from msgflow.plans import per_batch_schema_stream, product_stream_by_value, split_stream, validated_users_stream
from msgflow.plans import catalog
from msgflow.plans.corpus import event_messages
from msgflow.sources import ENVELOPE, replay_stream, sample, wide_envelope
from msgflow.sources.sample import first_document_of_stream
from msgflow.streaming import (
    AVAILABLE_NOW,
    ConvertedBatches,
    CounterListener,
    InferredBatches,
    SplitBatches,
    compact_versions,
    dead_letter_batch,
    every,
    parquet_stream,
    read_batches,
    read_versions,
    run_to_end,
    with_peek,
)
from pyspark.sql import functions as F
from pyspark.sql import types as T


@pytest.fixture
def send(spark, tmp_path):
    """Appends one file of messages to a replay directory and returns the directory."""
    sent = []

    def append(*texts):
        rows = [(b"k", None if t is None else t.encode(), "t", 0, len(sent) + i, None, 0) for i, t in enumerate(texts)]
        sent.extend(texts)
        spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(str(tmp_path / "topic"))
        return str(tmp_path / "topic")

    return append


def user(number):
    return f'{{"id":{number},"name":"n","age":{number}}}'


def test_restart_reads_only_what_is_new(spark, send, tmp_path):
    def run(source):
        messages = replay_stream(spark, source)
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
        run_to_end(validated_users_stream(messages, out, checkpoint, trigger=AVAILABLE_NOW))
        return sorted(row["id"] for row in spark.read.parquet(out).collect())

    source = send(user(1), "bad", user(2))
    assert run(source) == [1, 2]
    assert run(source) == [1, 2]
    send(user(3))
    assert run(source) == [1, 2, 3]


def test_running_query_with_an_interval(spark, send, tmp_path):
    source = send(user(1))
    query = validated_users_stream(replay_stream(spark, source), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    try:
        query.processAllAvailable()
        send(user(2))
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert every("30 seconds") == {"processingTime": "30 seconds"}


def test_a_query_that_does_not_end(spark, send, tmp_path):
    query = validated_users_stream(
        replay_stream(spark, send(user(1))), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    )
    with pytest.raises(TimeoutError):
        run_to_end(query, timeout=1)
    assert not query.isActive


def test_stream_equals_batch_over_several_batches(spark, send, tmp_path):
    for number in range(4):
        source = send(user(number), "bad", None)
    messages = replay_stream(spark, source, bytes_per_trigger=1)
    rows = fixed_schema_rows(wide_envelope(messages), USER, keep=["kafka_offset"])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = run_to_end(parquet_stream(rows, out, checkpoint, trigger=AVAILABLE_NOW))
    assert query.lastProgress.batchId == 3
    batch = fixed_schema_rows(wide_envelope(spark.read.schema(ENVELOPE).parquet(source)), USER, keep=["kafka_offset"])
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, written.collect())) == sorted(map(str, batch.collect()))


def test_registered_streams_run_in_bounded_batches(spark, sf_dir, tmp_path):
    path = catalog._staged(event_messages(spark, sf_dir), "bounded")
    messages = catalog.replayed(spark, path)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = run_to_end(split_stream(messages, out, f"{out}-bad", checkpoint, schema=USER, trigger=AVAILABLE_NOW))
    assert query.lastProgress.batchId >= 3


def test_a_sample_of_a_stream_reads_only_the_first_batches(spark, send, tmp_path, monkeypatch):
    looked = []
    look = sample.first_document
    monkeypatch.setattr(sample, "first_document", lambda batch: looked.append(1) or look(batch))
    source = send("bad")
    for texts in (["[1]", user(7), user(8)], [user(9)], [user(10)]):
        send(*texts)
    wide = wide_envelope(replay_stream(spark, source, files_per_trigger=1))
    assert first_document_of_stream(wide, str(tmp_path / "checkpoint")) == user(7)
    assert len(looked) == 2
    nothing = wide_envelope(replay_stream(spark, send(), files_per_trigger=9)).filter("json_string = 'bad'")
    assert first_document_of_stream(nothing, str(tmp_path / "other")) is None


def test_counters(spark, send, tmp_path):
    source = send(user(1), "bad", None)
    send(user(2))
    listener = CounterListener()
    spark.streams.addListener(listener)
    try:
        messages = replay_stream(spark, source, files_per_trigger=1)
        query = validated_users_stream(
            messages, str(tmp_path / "out"), str(tmp_path / "checkpoint"), trigger=AVAILABLE_NOW
        )
        run_to_end(query)
        assert listener.wait_for(query.runId) == {"users": {"seen": 4, "kept": 2, "skipped": 2}}
        assert listener.millis[str(query.runId)]["triggerExecution"] > 0
    finally:
        spark.streams.removeListener(listener)


def test_partitioned_sink(spark, send, tmp_path):
    texts = [f'{{"id":{i % 3},"product":"p{i}","price":1.5,"in_stock":true}}' for i in range(50)]
    source = send(*texts, "bad")
    out = str(tmp_path / "out")
    messages = replay_stream(spark, source)
    run_to_end(
        product_stream_by_value(messages, out, str(tmp_path / "checkpoint"), partition_by=["id"], trigger=AVAILABLE_NOW)
    )
    written = spark.read.parquet(out)
    assert written.columns[-1] == "id"
    assert len(glob.glob(f"{out}/id=*/*.parquet")) == 4
    assert {tuple(r) for r in written.groupBy("id").count().collect()} == {(0, 17), (1, 17), (2, 16), (None, 1)}


def test_a_hot_value_is_spread_over_several_files(spark, send, tmp_path):
    texts = [f'{{"id":{max(i - 3000, 0)},"product":"product {i * 7919}","price":{i}.5}}' for i in range(3010)]
    source = send(*texts[:1500])
    send(*texts[1500:])
    out, setting = str(tmp_path / "out"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "30k")
    try:
        messages = replay_stream(spark, source)
        run_to_end(
        product_stream_by_value(messages, out, str(tmp_path / "checkpoint"), partition_by=["id"], trigger=AVAILABLE_NOW)
    )
    finally:
        spark.conf.unset(setting)
    assert len(glob.glob(f"{out}/id=0/*.parquet")) > 1
    assert spark.read.parquet(out).count() == 3010


def test_split_job(spark, send, tmp_path):
    source = send(user(1), "bad", user(2))
    send("bad")
    send(user(3))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    messages = replay_stream(spark, source, files_per_trigger=1)
    run_to_end(split_stream(messages, good, bad, str(tmp_path / "checkpoint"), schema=USER, trigger=AVAILABLE_NOW))
    assert sorted(r["id"] for r in read_batches(spark, good).collect()) == [1, 2, 3]
    assert [r["json_string"] for r in read_batches(spark, bad).collect()] == ["bad", "bad"]


def test_a_batch_that_runs_twice_leaves_one_copy(spark, wide, tmp_path):
    counts = []
    write = SplitBatches(USER, str(tmp_path / "good"), str(tmp_path / "bad"), report=lambda n, c: counts.append((n, c)))
    batch = wide(user(1), "bad")
    for _ in range(2):
        write(batch, 7)
    write(batch.limit(0), 8)
    assert read_batches(spark, str(tmp_path / "good")).count() == 1
    assert read_batches(spark, str(tmp_path / "bad")).count() == 1
    assert counts == [(7, {"seen": 2, "good": 1, "bad": 1})] * 2
    inferred = InferredBatches(str(tmp_path / "inferred"))
    for _ in range(2):
        inferred(batch, 0)
    assert read_versions(spark, str(tmp_path / "inferred")).count() == 2


def test_schemas_drift_and_survive_a_restart(spark, wide, tmp_path):
    path = str(tmp_path / "data")
    texts = ['{"a":1}', '{"a":2.5}', '{"a":3,"b":{"c":1}}', '{"a":"x","b":{"d":"y"}}', "bad", '{"a":5}']
    for number, text in enumerate(texts):
        # A new writer each time, as after a restart.
        InferredBatches(path)(wide(text), number)
    rows = read_versions(spark, path).orderBy("a")
    assert rows.schema["a"].dataType.simpleString() == "string"
    assert rows.schema["b"].dataType.simpleString() == "struct<c:bigint,d:string>"
    assert [r["a"] for r in rows.collect()] == [None, "1", "2.5", "3.0", "5", "x"]
    assert len(glob.glob(f"{path}/schema_version=*")) == 3


def test_added_fields_make_no_new_version(spark, wide, tmp_path):
    path = str(tmp_path / "data")
    for number in range(12):
        InferredBatches(path)(wide(f'{{"a":1,"f{number}":{number},"s":{{"g{number}":"x"}}}}'), number)
    assert len(glob.glob(f"{path}/schema_version=*")) == 1
    rows = read_versions(spark, path)
    assert {f"f{n}" for n in range(12)} <= set(rows.columns)
    assert rows.selectExpr("count(f0)", "count(f11)", "count(s.g5)", "count(*)").first() == (1, 1, 1, 12)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_widened_columns_read_alike_in_any_zone(spark, wide, tmp_path, zone):
    path, setting = str(tmp_path / "data"), "spark.sql.session.timeZone"
    before = spark.conf.get(setting)
    spark.conf.set(setting, zone)
    try:
        write = ConvertedBatches(path, keep=["kafka_offset"])
        write(wide('{"at":"2024-03-22T14:35:00.25+05:30","n":9007199254740993}'), 0)
        write(wide('{"at":"2024-11-03T01:30:00-05:00","n":2.5}'), 1)
        write(wide('{"at":"soon","n":7}'), 2)
        rows = read_versions(spark, path, exact=True).select("at", "n").collect()
        assert sorted(map(tuple, rows)) == [
            ("2024-03-22T09:05:00.25Z", "9007199254740993"),
            ("2024-11-03T06:30:00Z", "2.5"),
            ("soon", "7.0"),
        ]
        assert dict(read_versions(spark, path).dtypes)["n"] == "double"
    finally:
        spark.conf.set(setting, before)


def test_a_new_checkpoint_keeps_earlier_runs(spark, send, tmp_path):
    source, good = send(user(1)), str(tmp_path / "good")
    for number in range(2):
        messages = replay_stream(spark, source)
        checkpoint = str(tmp_path / f"checkpoint-{number}")
        run_to_end(split_stream(messages, good, str(tmp_path / "bad"), checkpoint, schema=USER, trigger=AVAILABLE_NOW))
        run_to_end(split_stream(messages, good, str(tmp_path / "bad"), checkpoint, schema=USER, trigger=AVAILABLE_NOW))
        send(user(2))
    assert sorted(r["id"] for r in read_batches(spark, good).collect()) == [1, 1, 2]
    assert len(glob.glob(f"{good}/run=*/batch_id=0")) == 2


def test_a_batch_is_either_written_or_a_dead_letter(spark, wide, tmp_path):
    good, bad, errors = (str(tmp_path / name) for name in ("good", "bad", "errors"))
    fails = [True]

    class Flaky(SplitBatches):
        def process(self, batch, batch_id):
            counts = super().process(batch, batch_id)
            if fails[0]:
                raise RuntimeError
            return counts

    def report(batch_id, counts):
        raise ValueError("a report that fails")

    write = dead_letter_batch(Flaky(USER, good, bad, report), errors)
    batch = wide(user(1), "bad")
    write(batch, 0)
    assert not glob.glob(f"{good}/*") and not glob.glob(f"{bad}/*") and read_batches(spark, errors).count() == 2
    fails[0] = False
    with pytest.raises(ValueError):
        write(batch, 0)
    assert read_batches(spark, good).count() == read_batches(spark, bad).count() == 1
    assert not glob.glob(f"{errors}/*")


def test_counts_of_inferred_and_converted_batches(wide, tmp_path):
    counts = []
    report = lambda n, c: counts.append(dict(c))
    InferredBatches(str(tmp_path / "inferred"), report=report)(wide('{"a":1}', "bad", "[]", '[{"a":2},{"a":3}]'), 0)
    ConvertedBatches(str(tmp_path / "converted"), report=report)(wide('{"a":1}', "bad", "{}"), 0)
    ConvertedBatches(str(tmp_path / "empty"), str(tmp_path / "bad"), report=report)(wide("{}", "{}"), 0)
    assert counts == [
        {"seen": 4, "kept": 3, "rejected": 2},
        {"seen": 3, "kept": 2, "rejected": 1},
        {"seen": 2, "kept": 0, "rejected": 2},
    ]


def test_compaction_keeps_added_fields_and_versions(spark, wide, tmp_path):
    path, target = str(tmp_path / "data"), str(tmp_path / "compacted")
    for number, text in enumerate(['{"a":1}', '{"a":2,"b":"x"}', '{"a":3,"c":{"d":1}}', '{"a":2.5}', '{"a":4,"e":true}']):
        InferredBatches(path)(wide(text), number)
    compact_versions(spark, path, target)
    assert len(glob.glob(f"{target}/schema_version=*/*.parquet")) == 2
    before, after = read_versions(spark, path), read_versions(spark, target)
    assert before.schema == after.schema
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))


def test_payload_named_like_the_folders(spark, wide, tmp_path):
    text = '{"batch_id":"mine","schema_version":"too"}'
    schema = T.StructType().add("batch_id", "string").add("schema_version", "string")
    SplitBatches(schema, str(tmp_path / "good"), str(tmp_path / "bad"))(wide(text), 3)
    InferredBatches(str(tmp_path / "data"))(wide(text), 3)
    for rows in (read_batches(spark, str(tmp_path / "good")), read_versions(spark, str(tmp_path / "data"))):
        assert rows.select("batch_id", "schema_version").collect() == [("mine", "too")]


def test_each_batch_with_its_own_schema(spark, wide, tmp_path):
    write = InferredBatches(str(tmp_path / "data"), accumulate=False)
    write(wide('{"a":1}'), 0)
    write(wide('{"a":"x"}'), 1)
    types = [spark.read.parquet(f"{tmp_path}/data/batch_id={n}").schema["a"].dataType.simpleString() for n in (0, 1)]
    assert types == ["bigint", "string"]


def test_converted_batches(spark, wide, tmp_path):
    write = ConvertedBatches(str(tmp_path / "data"), str(tmp_path / "bad"), keep=["kafka_offset"])
    write(wide("bad", "[1]"), 0)
    write(wide('{"at":"2024-03-22"}', "bad"), 1)
    write(wide('{"at":"soon"}'), 2)
    rows = read_versions(spark, str(tmp_path / "data"))
    assert sorted(map(tuple, rows.collect())) == [(0, "2024-03-22T00:00:00Z"), (0, "soon")]
    assert read_batches(spark, str(tmp_path / "bad")).count() == 3


def test_failed_batch_is_kept_whole(spark, wide, send, tmp_path):
    def strict(batch, batch_id):
        strict_records(batch).write.mode("overwrite").parquet(f"{tmp_path}/data/batch_id={batch_id}")

    write = dead_letter_batch(strict, str(tmp_path / "errors"))
    write(wide(user(1)), 0)
    for _ in range(2):
        write(wide(user(2), "bad"), 1)
    assert read_batches(spark, str(tmp_path / "data")).count() == 1
    errors = read_batches(spark, str(tmp_path / "errors"))
    assert errors.columns == wide().columns
    assert [r["json_string"] for r in errors.collect()] == [user(2), "bad"]


def test_a_schema_version_without_rows_is_skipped(spark, wide, tmp_path):
    path = str(tmp_path / "data")
    InferredBatches(path)(wide('{"a":1}'), 0)

    class Broken(InferredBatches):
        def rows(self, batch, schema):
            raise RuntimeError

    dead_letter_batch(Broken(path), str(tmp_path / "errors"))(wide('{"b":1}'), 1)
    InferredBatches(path)(wide('{"c":1}'), 2)
    rows = read_versions(spark, path)
    assert rows.count() == 2 and {"a", "c"} <= set(rows.columns)


def test_per_batch_schema_job(spark, send, tmp_path):
    source = send('{"a":1}', "bad")
    out, errors = str(tmp_path / "data"), str(tmp_path / "errors")
    messages = replay_stream(spark, source)
    run_to_end(per_batch_schema_stream(messages, out, errors, str(tmp_path / "checkpoint"), trigger=AVAILABLE_NOW))
    rows = read_versions(spark, out).select("kafka_offset", "a", "_corrupt_record").collect()
    assert sorted(map(tuple, rows)) == [(0, 1, None), (1, None, "bad")]


def test_compaction(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    spark.range(1000).withColumn("d", F.col("id") % 2).repartition(40).write.parquet(f"{small}/batch_id=1")
    compact(spark, small, large, ignore_folders=True)
    files = glob.glob(f"{large}/*.parquet")
    assert len(files) == 1 and spark.read.parquet(large).columns == ["id", "d"]
    assert spark.read.parquet(large).exceptAll(spark.read.parquet(small).drop("batch_id")).isEmpty()
    compact(spark, small, f"{large}-by-d", partition_by=["d"], ignore_folders=True)
    assert len(glob.glob(f"{large}-by-d/d=*/*.parquet")) == 2
    assert spark.read.parquet(f"{large}-by-d").count() == 1000
    size = sum(map(len, (open(f, "rb").read() for f in glob.glob(f"{small}/*/*.parquet"))))
    compact(spark, small, f"{large}-four", target_bytes=size // 4 + 1)
    assert 4 <= len(glob.glob(f"{large}-four/*.parquet")) <= 6


def test_file_format(spark, tmp_path):
    spark.range(10).selectExpr("'same' AS text").coalesce(1).write.parquet(str(tmp_path / "small"))
    compact(spark, str(tmp_path / "small"), str(tmp_path / "out"))
    column = pq.ParquetFile(glob.glob(f"{tmp_path}/out/*.parquet")[0]).metadata.row_group(0).column(0)
    assert column.compression == "SNAPPY" and column.is_stats_set
    assert "PLAIN_DICTIONARY" in column.encodings  # the name dictionary pages have in format 1


def test_legacy_layout(spark, tmp_path):
    def list_column(path):
        spark.sql("SELECT array(1) AS l").coalesce(1).write.parquet(path)
        return pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).schema.column(0).path

    with legacy_layout(spark):
        assert list_column(str(tmp_path / "old")) == "l.array"
    assert list_column(str(tmp_path / "new")) == "l.list.element"


def test_peek(wide, capsys):
    written = []
    with_peek(lambda batch, batch_id: written.append(batch.count()))(wide("a", "b", "c"), 5)
    shown = capsys.readouterr().out
    assert written == [3] and "batch 5" in shown and "json_string: string" in shown
    assert "|a " in shown and "|c " not in shown
