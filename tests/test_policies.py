import datetime

import pytest
from msgflow.operators import (
    FALLBACK_EVENT,
    USER,
    array_rows,
    bad_rows,
    batch_schema,
    captured_rows,
    converted_rows,
    fixed_schema_rows,
    good_rows,
    inferred_rows,
    lenient_records,
    parse_with_capture,
    recursive_schema,
    rejected_rows,
    split_counts,
    strict_records,
)
from msgflow.plans import literal_users
from msgflow.sources import ENVELOPE, literal_messages, narrow_envelope, wide_envelope
from pyspark.errors import PySparkException
from pyspark.sql import types as T

USERS = [f'{{"id": {n}, "name": "user {n}", "age": {40 + n}}}' for n in (11, 12, 13)]
TRANSACTION = (
    '{"transaction_id":"t-1","timestamp":"2024-03-22T14:35:00Z",'
    '"items":[{"item_id":"a","quantity":4,"price":2.5},{"item_id":"b","quantity":3,"price":0.75}],"total_amount":12.25}'
)
# Texts without the three fields of a user, for different reasons.
UNUSABLE = ["", "null", "not json", "[]", f"[{USERS[0]}]", "123", '{"id":1,"name":"x"}', USERS[0][:-1], None]


def tuples(rows):
    return [tuple(row) for row in rows.collect()]


def test_envelopes(spark):
    at = datetime.datetime(2024, 3, 22, 14, 35)
    rows = spark.createDataFrame([(None, b"{}", "t", 1, 7, at, 0), (b"k", None, "t", 0, 8, at, 0)], ENVELOPE)
    assert tuples(wide_envelope(rows)) == [("no_key", "{}", at, "t", 1, 7), ("k", None, at, "t", 0, 8)]
    assert tuples(narrow_envelope(rows)) == [(None, "{}", at), ("k", None, at)]


def test_literal_job(spark, tmp_path):
    for _ in range(2):
        literal_users(spark, USERS, str(tmp_path / "users"))
    users = spark.read.parquet(str(tmp_path / "users"))
    assert users.dtypes == [("id", "int"), ("name", "string"), ("age", "int")]
    expected = [(n, f"user {n}", 40 + n) for n in (11, 12, 13)]
    assert sorted(tuples(users)) == sorted(expected * 2)


@pytest.mark.parametrize("text", UNUSABLE)
def test_strict_fails_and_lenient_skips(spark, text):
    messages = literal_messages(spark, [USERS[0], text])
    assert tuples(lenient_records(messages)) == [(11, "user 11", 51)]
    with pytest.raises(PySparkException, match="not a JSON object with the fields"):
        strict_records(messages).collect()


def test_the_error_names_the_message_but_not_its_text(wide):
    with pytest.raises(PySparkException) as caught:
        strict_records(wide("secret"), keep=["kafka_partition", "kafka_offset"]).collect()
    assert "kafka_offset 0" in str(caught.value) and "secret" not in str(caught.value).split("\n")[0]


def test_repeated_keys_and_trailing_text(spark):
    messages = literal_messages(spark, ['{"id":1,"id":2,"name":"n","age":3}', USERS[0] + USERS[1]])
    assert tuples(lenient_records(messages)) == [(2, "n", 3), (11, "user 11", 51)]


def test_relaxed_json_is_malformed_for_records(spark):
    messages = literal_messages(spark, ["{'id':1,'name':'n','age':3}", '{"id":NaN,"name":"n","age":3}'])
    assert tuples(lenient_records(messages)) == []


def test_fixed_schema(spark):
    texts = [USERS[0], '{"id":"x","name":7}', "not json", "", None, '{"unknown":1}']
    rows = tuples(fixed_schema_rows(literal_messages(spark, texts), USER))
    assert rows == [(11, "user 11", 51), (None, "7", None), *[(None, None, None)] * 4]


def test_split(spark, wide):
    texts = ['{"id":1}', "not json", "", None, "{}", '{"id":1} {"id":2}', '{"message_key":"z"}', "[1]"]
    parsed = parse_with_capture(wide(*texts).select("message_key", "json_string", "kafka_timestamp"), FALLBACK_EVENT)
    assert good_rows(parsed).columns == ["message_key", "kafka_timestamp", "id", "timestamp", "payload"]
    assert [row["id"] for row in good_rows(parsed).collect()] == ["1", None, "1", None]
    bad = bad_rows(parsed)
    assert bad.columns == ["message_key", "json_string", "kafka_timestamp", "parsed_data", "corrupt_record"]
    assert [row["json_string"] for row in bad.collect()] == ["not json", "", None, "[1]"]
    assert tuples(split_counts(parsed)) == [(8, 4, 4)]


def test_payload_names_that_the_envelope_has(wide):
    messages = wide('{"message_key":"z","payload_message_key":1,"KAFKA_OFFSET":2}')
    rows = inferred_rows(messages, batch_schema(messages))
    assert rows.first().asDict() == {
        "message_key": "k",
        "kafka_timestamp": None,
        "kafka_topic": "t",
        "kafka_partition": 0,
        "kafka_offset": 0,
        "_corrupt_record": None,
        "payload_KAFKA_OFFSET": 2,
        "payload_message_key": "z",
        "payload_message_key_1": 1,
    }
    schema = T.StructType().add("message_key", "string")
    assert good_rows(parse_with_capture(messages, schema)).columns[-1] == "payload_message_key"


def test_names_that_differ_in_case(wide, tmp_path):
    messages = wide('{"a":1,"A":2,"s":{"x":1,"X":2}}')
    rows = inferred_rows(messages, batch_schema(messages), keep=["kafka_offset"])
    rows.write.parquet(str(tmp_path / "out"))
    row = messages.sparkSession.read.parquet(str(tmp_path / "out")).first()
    assert (row["A"], row["a_1"], row["s"]["X"], row["s"]["x_1"]) == (2, 1, 2, 1)


def test_inferred_rows_belong_to_their_message(wide):
    texts = ['{"a":1}', "bad", None, '[{"a":2},{"a":3}]', "[]", '{"a":4']
    messages = wide(*texts)
    rows = inferred_rows(messages, batch_schema(messages), keep=["kafka_offset"])
    assert tuples(rows) == [(0, None, 1), (1, "bad", None), (2, None, None), (3, None, 2), (3, None, 3), (4, "[]", None), (5, '{"a":4', None)]


def test_inferred_rows_without_any_object(wide):
    messages = wide("bad", None, "{}", "[]", '{"a":{}}')
    rows = inferred_rows(messages, batch_schema(messages), keep=["kafka_offset"])
    assert tuples(rows) == [(0, "bad"), (1, None), (2, None), (3, "[]"), (4, None)]


def test_array_rows(wide):
    schema = T.StructType().add("a", "string")
    messages = wide('[{"a":1},{"a":2}]', '{"a":3}', "[]", "bad")
    assert tuples(array_rows(messages, schema, keep=["kafka_offset"])) == [(0, "1"), (0, "2"), (1, "3"), (2, None), (3, None)]


def test_captured_rows(wide):
    schema = T.StructType().add("a", "integer").add("b", "string")
    messages = wide('{"a":"x","b":"y"}', '{"a":1}', None, "", " \t\n")
    expected = [(None, "y", '{"a":"x","b":"y"}'), (1, None, None), (None, None, None), (None, None, ""), (None, None, " \t\n")]
    assert tuples(captured_rows(messages, schema)) == expected


def test_transaction(wide):
    messages = wide(TRANSACTION)
    sale = converted_rows(messages, recursive_schema(messages)).first()
    assert sale["timestamp"] == datetime.datetime(2024, 3, 22, 14, 35)
    total = sum(item["quantity"] * item["price"] for item in sale["items"])
    assert total == pytest.approx(sale["total_amount"])


def test_conversion_by_name_and_rejects(wide):
    schema = recursive_schema(wide('{"specs":{"at":"2024-03-22T14:35:00Z","v":1},"when":"2024-03-22"}'))
    messages = wide(
        '{"when":"2024-03-23","specs":{"v":2,"at":"2024-03-22 10:00"}}',  # other order of fields
        '{"extra":1}',
        '{"when":"tomorrow"}',
        '{"specs":{"at":"x"}}',
        '{"specs":{"v":"x"}}',
        "[1]",
        "null",
        "bad",
        None,
        '{"specs":null}',
    )
    good = converted_rows(messages, schema, keep=["kafka_offset"]).collect()
    assert [row["kafka_offset"] for row in good] == [0, 1, 9]
    assert good[0]["specs"].asDict() == {"at": datetime.datetime(2024, 3, 22, 10), "v": 2}
    assert good[1]["specs"] is None and good[2]["specs"] is None
    rejected = rejected_rows(messages, schema, keep=["kafka_offset"]).collect()
    assert [row["kafka_offset"] for row in rejected] == [2, 3, 4, 5, 6, 7, 8]
    assert rejected[0]["json_string"] == '{"when":"tomorrow"}'


def test_nothing_vanishes_under_a_schema_without_fields(wide):
    messages = wide("{}", "[]", "bad", None)
    schema = recursive_schema(messages)
    assert not schema.fields and converted_rows(messages, schema).count() == 0
    rejected = rejected_rows(messages, schema, keep=["kafka_offset"])
    assert tuples(rejected) == [(0, "{}"), (1, "[]"), (2, "bad"), (3, None)]


def test_keys_repeated_inside_a_field_keep_the_last(wide):
    messages = wide('{"id":1,"name":{"a":1,"a":2},"age":3,"age":4}')
    assert tuples(lenient_records(messages)) == [(1, "Unknown", 4)]
    assert tuples(strict_records(messages)) == [(1, "", 4)]
