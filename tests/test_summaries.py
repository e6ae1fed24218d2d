"""Schemas from summaries alone, against a fresh inference over all messages."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from msgflow.operators import merged_summaries, recursive_schema, schema_conflicts, schema_summary, summarized_schema
from msgflow.streaming import ConvertedBatches, OutputLog, read_versions

VALUES = st.recursive(
    st.sampled_from([None, True, 1, 2**40, 2.5, 2.0, 1e300, "x", "2024-03-22", "2024-03-22T14:35:00Z", 10**22, [], [1], ["a", 2], {}]),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["a", "b", "C d", "é'", 'q"']), inner, max_size=3),
    max_leaves=6,
)
TEXTS = st.one_of(st.sampled_from(["bad", "[1]", "", None, "{"]), st.dictionaries(st.sampled_from("abc"), VALUES, max_size=3).map(json.dumps))


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "json_string string")


@settings(deadline=None, max_examples=25, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(TEXTS, min_size=1, max_size=5), min_size=1, max_size=3))
def test_equal_to_a_fresh_inference(spark, batches):
    summaries = None
    for batch in batches:
        rows = schema_summary(texts(spark, batch))
        summaries = rows if summaries is None else summaries.unionByName(rows)
    everything = texts(spark, [text for batch in batches for text in batch])
    assert summarized_schema(spark, summaries) == recursive_schema(everything)


def test_counts_and_conflicts(spark):
    rows = ['{"a":1,"b":{"c":"2024-03-22"}}', '{"a":"x","b":{"c":"soon","d":null}}', '{"a":2}', '{"b":7}', "bad", "[1]", None, "{}"]
    summary = schema_summary(texts(spark, rows))
    counts = {(".".join(r["path"]), r["kind"]): r["messages"] for r in summary.collect()}
    # b.c is no path of its own where b is a number as well: text in the end.
    assert counts == {("a", "BIGINT"): 2, ("a", "STRING"): 1, ("b", "OBJECT"): 2, ("b", "BIGINT"): 1}
    assert {tuple(r["path"]) for r in schema_conflicts(summary).collect()} == {("a",), ("b",)}
    twice = merged_summaries(summary.unionByName(summary))
    assert {(r["kind"]): r["messages"] for r in twice.where("path[0] = 'b'").collect()} == {"OBJECT": 4, "BIGINT": 2}


def test_nothing_to_summarize(spark):
    empty = schema_summary(texts(spark, ["bad", None, "{}"]))
    assert empty.collect() == [] and summarized_schema(spark, empty).fields == []


@pytest.mark.parametrize("published", [True, False])
def test_summaries_of_batches(spark, wide, tmp_path, published):
    log = OutputLog(str(tmp_path / "log")) if published else None
    data, summaries = str(tmp_path / "data"), str(tmp_path / "summaries")
    batches = [['{"a":1,"t":"2024-03-22"}', "bad"], ['{"a":2.5}', '{"t":"soon","n":{"x":true}}'], ['{"n":{"y":[1]}}']]
    write = ConvertedBatches(data, log=log, summary_path=summaries)
    for number, batch in enumerate(batches):
        for _ in range(2):  # each batch runs twice
            write(wide(*batch), number)
    rows = log.read(spark, summaries) if published else spark.read.option("recursiveFileLookup", "true").parquet(summaries)
    everything = texts(spark, [text for batch in batches for text in batch])
    assert summarized_schema(spark, rows) == recursive_schema(everything)
    assert {r["kind"]: r["messages"] for r in merged_summaries(rows).where("path = array('a')").collect()} == {
        "BIGINT": 1,
        "DECIMAL(2,1)": 1,
    }
    assert read_versions(spark, data, log=log).count() == 4
