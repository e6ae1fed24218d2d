"""Tables that batches keep up to date: profiles, samples, sketches; and rows clustered along a curve."""

import datetime
import glob
import random

import pyarrow.parquet as pq
import pytest
from msgflow.operators import (
    clustered,
    merged_sample,
    merged_sketches,
    message_sample,
    sketched_figures,
    topic_profile,
    topic_sketches,
)
from msgflow.sources import ENVELOPE, replay_stream, wide_envelope
from msgflow.streaming import AVAILABLE_NOW, KeptTable, OutputLog, profile_stream, read_kept, run_to_end, upserted
from msgflow.streaming.account import PROFILE
from pyspark.sql import functions as F


def envelope(spark, rows):
    """Messages of (topic, partition, offset, key, value)."""
    coded = lambda text: None if text is None else text.encode()
    full = [(coded(k), coded(v), t, p, o, None, 0) for t, p, o, k, v in rows]
    return spark.createDataFrame(full, ENVELOPE)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_the_running_profile_equals_that_of_all_messages(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))
    log = OutputLog(str(tmp_path / "log"))
    rng = random.Random(1)
    assert read_kept(spark, out, log, PROFILE).collect() == []
    for batch in range(4):
        rows = [(rng.choice("ab"), rng.choice([0, 1, None]), batch * 100 + i, None, None) for i in range(20)]
        envelope(spark, rows).coalesce(1).write.mode("append").parquet(topic)
        run_to_end(profile_stream(replay_stream(spark, topic), out, log, checkpoint, trigger=AVAILABLE_NOW))
        expected = topic_profile(spark.read.schema(ENVELOPE).parquet(topic))
        assert collected(read_kept(spark, out, log, PROFILE)) == collected(expected)


def test_upserts(spark):
    update = upserted(["k", "p"])
    rows = lambda *r: spark.createDataFrame(r, "k string, p int, n int")
    known = update(None, rows(("a", 1, 1), ("a", None, 2), (None, None, 3)))
    assert collected(update(known, rows(("a", None, 9), ("b", 1, 8)))) == sorted(
        [("a", 1, 1), ("a", None, 9), (None, None, 3), ("b", 1, 8)], key=repr
    )


def test_a_kept_table_counts_a_batch_once(spark, tmp_path):
    log, path = OutputLog(str(tmp_path / "log")), str(tmp_path / "sum")
    add = lambda known, batch: (batch if known is None else known.unionByName(batch)).agg(F.sum("id").alias("id"))
    for batch_id in (0, 1, 1, 2, 2, 2):
        KeptTable(path, log, "id bigint", add)(spark.range(10 * batch_id, 10 * batch_id + 10), batch_id)
    assert read_kept(spark, path, log, "id bigint").first()["id"] == sum(range(30))


def test_samples_do_not_depend_on_partitions_or_batches(spark):
    rows = [("t", i % 3, i, None, f'{{"n":{i}}}') for i in range(500)] + [(None, None, 7, None, None)]
    wide = wide_envelope(envelope(spark, rows))
    whole = collected(message_sample(wide, 40))
    assert len(whole) == 40 and whole == collected(message_sample(wide.repartition(13), 40))
    parts = [message_sample(wide.where(F.col("kafka_offset") % 4 == n), 40) for n in range(4)]
    merged = parts[0]
    for part in (*parts[1:], parts[0]):  # one part comes twice
        merged = merged_sample(merged.unionByName(part), 40)
    assert collected(merged) == whole
    assert message_sample(wide.limit(0), 5).collect() == [] and message_sample(wide, 1000).count() == 501


def test_sketches_of_batches_merge(spark):
    rng = random.Random(2)
    rows = [("a", 0, i, f"k{rng.randint(0, 5000)}", "x" * rng.randint(0, 300)) for i in range(8000)]
    rows += [("b", 0, i, None, None) for i in range(3)]
    parts = [topic_sketches(envelope(spark, rows[n::4])) for n in range(4)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged_sketches(merged.unionByName(part))
    found = {r["topic"]: r for r in sketched_figures(merged).collect()}
    keys, sizes = len({r[3] for r in rows if r[3]}), sorted(len(r[4]) for r in rows if r[4] is not None)
    assert found["a"]["messages"] == 8000 and abs(found["a"]["distinct_keys"] - keys) <= 0.05 * keys
    for share, size in zip((0.5, 0.9, 0.99), found["a"]["sizes"], strict=True):
        assert abs(sum(s <= size for s in sizes) / len(sizes) - share) <= 0.02
    assert (found["b"]["messages"], found["b"]["distinct_keys"], found["b"]["sizes"]) == (3, 0, None)


def read_share(folder, name, low, high):
    """The share of row groups that a filter on a column has to read."""
    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in glob.glob(f"{folder}/*.parquet") if pq.ParquetFile(f).metadata.num_rows]
    stats = [next(g.column(i) for i in range(g.num_columns) if g.column(i).path_in_schema == name).statistics for g in groups]
    return sum(s.min <= high and s.max >= low for s in stats) / len(stats)


def test_files_prune_on_both_columns(spark, tmp_path):
    rng = random.Random(3)
    begin = datetime.datetime(2024, 1, 1)
    rows = [(rng.gauss(0, 1), begin + datetime.timedelta(minutes=rng.randint(0, 10**6)), i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "x double, at timestamp, n int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        clustered(df, ["x", "n"]).write.parquet(str(tmp_path / "z"))
        df.repartition(64).write.parquet(str(tmp_path / "plain"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for name, low, high in (("x", 0.5, 0.6), ("n", 5000, 5500)):
        assert read_share(tmp_path / "z", name, low, high) < 0.35 < read_share(tmp_path / "plain", name, low, high)
    assert collected(spark.read.parquet(str(tmp_path / "z")).select("n")) == [(i,) for i in sorted(range(20_000), key=lambda i: repr((i,)))]


def test_columns_to_cluster_by(spark):
    rows = [(1, datetime.date(2024, 1, 1), None, "a"), (None, None, datetime.datetime(2024, 1, 1), "b"), (3, None, None, "c")]
    df = spark.createDataFrame(rows, "n int, d date, t timestamp_ntz, _place string")
    assert collected(clustered(df, ["n", "d", "t"])) == collected(df)
    assert clustered(df.limit(0), ["n"]).collect() == []
    with pytest.raises(ValueError, match="must be a number"):
        clustered(df, ["_place"])
