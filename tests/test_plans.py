"""Physical plans: what must not be in them at scale."""

import contextlib
import io

from msgflow.operators import (
    USER,
    converted_rows,
    good_rows,
    inferred_rows,
    lenient_records,
    parse_with_capture,
    recursive_schema,
    request_batches,
    strict_records,
    topic_profile,
)
from msgflow.sources import replay_batch, wide_envelope
from msgflow.plans.corpus import event_messages
from pyspark.sql import functions as F


def plan_of(rows):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        rows.explain("formatted")
    return text.getvalue()


def test_policies_parse_once_and_do_not_shuffle(spark, sf_dir, tmp_path):
    event_messages(spark, sf_dir).write.parquet(str(tmp_path / "topic"))
    messages = wide_envelope(replay_batch(spark, str(tmp_path / "topic")))
    schema = recursive_schema(messages)
    for rows in (
        strict_records(messages),
        lenient_records(messages),
        good_rows(parse_with_capture(messages, USER)),
        inferred_rows(messages, schema),
        converted_rows(messages, schema),
    ):
        plan = plan_of(rows)
        assert plan.count("from_json(") == 1
        assert "Exchange" not in plan and "Python" not in plan


def test_scans_read_what_they_need(spark, sf_dir, tmp_path):
    event_messages(spark, sf_dir).write.parquet(str(tmp_path / "topic"))
    envelope = replay_batch(spark, str(tmp_path / "topic"))
    assert "ReadSchema: struct<value:binary>\n" in plan_of(lenient_records(wide_envelope(envelope)))
    profile = plan_of(topic_profile(envelope.filter("topic = 'purchase'")))
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint>" in profile
    assert "EqualTo(topic,purchase)" in profile
    near = wide_envelope(envelope).filter("kafka_partition = 0 AND kafka_offset BETWEEN 5 AND 10")
    assert "GreaterThanOrEqual(offset,5), LessThanOrEqual(offset,10)" in plan_of(near)


def test_requests_do_not_sort_contents_in_a_window(spark):
    """Places come from the keys alone; the contents are joined to them and grouped by request."""
    items = spark.range(100).selectExpr("IF(id < 80, 0, id % 5) AS g", "id AS n", "repeat('x', 100) AS payload")
    plan = plan_of(request_batches(items, group="g", order="n", size=3, content=F.col("payload")))
    assert "Window" not in plan
