import json
import random

import pytest
from msgflow.functions import is_iso_timestamp
from msgflow.operators import (
    DEFAULT_SCHEMA,
    batch_schema,
    inferred_rows,
    merge_schemas,
    recursive_schema,
    sample_schema,
    schema_of_sample,
)
from msgflow.operators import inference
from msgflow.operators.inference import _aggregates, _first_shape, counted_recursive_schema
from msgflow.operators.shape import align, unique_names
from msgflow.sources import first_document
from pyspark.sql import functions as F
from pyspark.sql import types as T


def of(schema):
    return schema.simpleString().removeprefix("struct<").removesuffix(">")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"a":1,"b":"x","c":2.5,"d":null,"e":[1]}', "a:bigint,b:string,c:double,d:string,e:array<bigint>"),
        ('[{"a":1},{"b":true}]', "a:bigint,b:boolean"),
        ('{"n":{"m":1}}', "n:struct<m:bigint>"),
        ("not json", None),
        ("123", None),
        ("{}", None),
        ("", None),
    ],
)
def test_schema_of_one_sample(spark, text, expected):
    schema = schema_of_sample(spark, text)
    assert (None if schema is None else of(schema)) == expected


def test_sample_is_the_first_object(wide):
    assert first_document(wide("bad", None, "", "[]", '{"a":1}', '{"b":1}')) == '{"a":1}'
    assert first_document(wide('{"a":1', '{"a":{"b":[1,}}', '{"b":2}')) == '{"b":2}'
    assert sample_schema(wide("bad", None)) == DEFAULT_SCHEMA
    assert sample_schema(wide()) == DEFAULT_SCHEMA


def test_sample_beyond_the_first_window(wide):
    messages = wide(*["bad"] * 30, '{"a":1}')
    assert first_document(messages, window=10) == '{"a":1}'


@pytest.mark.parametrize(
    ("texts", "expected"),
    [
        (['{"a":1}', '{"a":2.5}'], "a:double"),
        (['{"a":1}', '{"a":2.0}'], "a:double"),
        (['{"a":1}', '{"a":"x"}'], "a:string"),
        (['{"a":1}', '{"a":{"b":1}}'], "a:string"),
        (['{"a":null}', '{"a":1}'], "a:bigint"),
        (['{"a":null}'], "a:string"),
        (['{"a":12345678901234567890}'], "a:decimal(20,0)"),
        (['{"a":12345678901234567890}', '{"a":1}'], "a:decimal(20,0)"),
        (['{"a":12345678901234567890}', '{"a":1.0}'], "a:double"),
        (['{"a":[1,"x"]}'], "a:array<string>"),
        (['{"a":{}}', '{"b":1}'], "b:bigint"),
        (['{"a":[{}]}', '{"b":[]}'], "b:array<string>"),
        (['{"b":1}', '[{"a":1}]', "[1]", "[]", "5", "bad", None], "b:bigint,a:bigint"),
        (['[{"a":1},5]'], ""),
        (["{'a':1}", '{"b":NaN}'], "a:bigint,b:double"),
        (['{"a":1,"a":2}', '{"c":{"d":1,"d":2}}'], "a:bigint,c:struct<d:bigint>"),
        (['{"x y":1,"OBJECT<":{"q`t":1}}'], "OBJECT<:struct<q`t:bigint>,x y:bigint"),
        (["bad"], ""),
    ],
)
def test_batch_schema(wide, texts, expected):
    assert of(batch_schema(wide(*texts))) == expected


@pytest.mark.parametrize(
    ("texts", "expected"),
    [
        (['{"a":"2024-03-22"}', '{"a":null}'], "a:timestamp"),
        (['{"a":"2024-03-22"}', '{"a":"x"}'], "a:string"),
        (['{"a":"x"}', '{"a":"2024-03-22"}'], "a:string"),
        (['{"a":"2024-03-22"}', '{"a":5}'], "a:string"),
        (['{"a":null}'], "a:string"),
        (['{"s":{"t":{"u":"2024-03-22T14:35:00+05:30"}}}'], "s:struct<t:struct<u:timestamp>>"),
        (['{"a":["2024-03-22"]}'], "a:array<string>"),
        (['{"a":1}', '[{"b":1}]'], "a:bigint"),
    ],
)
def test_recursive_schema(wide, texts, expected):
    assert of(recursive_schema(wide(*texts).coalesce(1))) == expected


class Documents:
    """Random JSON texts, some malformed or not objects."""

    def __init__(self, seed):
        self.random = random.Random(seed)

    def value(self, depth=2):
        r = self.random
        leaf = r.choice([None, True, False, 1, -5, 2**40, 1.5, 2.0, 1e20, -0.25, 1e-7, "x", "2024-03-22", "5", "é\n"])
        nested = r.choice([self.object, self.list]) if depth and r.random() < 0.3 else None
        return nested(depth - 1) if nested else leaf

    def list(self, depth):
        return [self.value(depth) for _ in range(self.random.randrange(4))]

    def object(self, depth=2):
        return {name: self.value(depth) for name in self.random.sample("abcde", self.random.randrange(5))}

    def text(self):
        kind = self.random.randrange(20)
        if kind < 2:
            return self.random.choice(["bad", "5", "null", "[1]", '"s"', "[]"])
        if kind == 2:
            return json.dumps([self.object() for _ in range(self.random.randrange(3))])
        return json.dumps(self.object())[: -1 if kind == 3 else None]


def test_inference_and_rows_against_the_json_reader(spark, wide):
    for seed in range(25):
        documents = Documents(seed)
        texts = [documents.text() for _ in range(documents.random.randrange(1, 6))]
        reader = spark.read.json(spark.sparkContext.parallelize(texts, 1), multiLine=True)
        messages = wide(*texts).coalesce(1)
        schema = batch_schema(messages)
        expected_fields = {f.name: f.dataType for f in reader.schema.fields if f.name != "_corrupt_record"}
        assert {f.name: f.dataType for f in schema.fields} == expected_fields, texts
        names = [*expected_fields, *(["_corrupt_record"] if "_corrupt_record" in reader.columns else [])]
        rows = inferred_rows(messages, schema, keep=[])
        if names:
            # The reader drops arrays without elements; here they keep a row, with their text.
            found = [r[: len(names)] for r in rows.select(*names, "_corrupt_record").collect() if r[-1] != "[]"]
            assert found == [tuple(r) for r in reader.select(*names).collect()], texts
        assert rows.where("_corrupt_record = '[]'").count() == texts.count("[]")
        assert rows.where("_corrupt_record IS NULL OR _corrupt_record != '[]'").count() == reader.count()


@pytest.mark.parametrize("persist", [False, True])
def test_timestamps_below_names_with_quotes(wide, persist):
    texts = [json.dumps({"o'": {'q"': "2024-03-22", "b'\"": "2024-03-22T10:00Z", "t]": "x"}, "n": 12345678901234567890})]
    schema = recursive_schema(wide(*texts, "bad", None, "[1]"), persist=persist)
    types = {f.name: f.dataType.simpleString() for f in schema["o'"].dataType.fields}
    assert types == {'q"': "timestamp", "b'\"": "timestamp", "t]": "string"}
    assert schema["n"].dataType.simpleString() == "decimal(20,0)"


def test_inference_keeps_the_last_of_repeated_keys(wide):
    assert batch_schema(wide('{"a":"x","a":1,"s":{"b":"y","b":2}}')).simpleString() == "struct<a:bigint,s:struct<b:bigint>>"


@pytest.mark.parametrize(
    ("first", "second", "expected"),
    [
        ("bigint", "double", "double"),
        ("bigint", "decimal(20,0)", "decimal(20,0)"),
        ("decimal(20,0)", "double", "double"),
        ("bigint", "string", "string"),
        ("timestamp", "string", "string"),
        ("boolean", "bigint", "string"),
        ("struct<a:bigint>", "struct<b:string,a:double>", "struct<a:double,b:string>"),
        ("array<bigint>", "array<string>", "array<string>"),
        ("struct<a:bigint>", "bigint", "string"),
    ],
)
def test_merge_and_align(spark, first, second, expected):
    a, b = T.DataType.fromDDL(first), T.DataType.fromDDL(second)
    merged = merge_schemas(a, b)
    assert merged.simpleString() == expected
    empty = spark.range(1).select(align(F.lit(None).cast(a), a, merged).alias("v"))
    assert empty.schema["v"].dataType == merged or isinstance(merged, (T.StructType, T.ArrayType))


def test_align_values(spark):
    rows = spark.sql("SELECT named_struct('a', 1L) AS s, 7L AS n, array(named_struct('a', 1L)) AS l")
    s, n, l = (rows.schema[name].dataType for name in ("s", "n", "l"))
    wider = T.DataType.fromDDL("struct<a:string,b:double>")
    row = rows.select(
        align(F.col("s"), s, wider).alias("s"),
        align(F.col("n"), n, T.StringType()).alias("n"),
        align(F.col("l"), l, T.ArrayType(wider)).alias("l"),
        align(F.col("s"), s, T.StringType()).alias("t"),
    ).first()
    assert row["s"].asDict() == {"a": "1", "b": None}
    assert row["n"] == "7" and row["l"][0]["a"] == "1" and row["t"] == '{"a":1}'


def test_unique_names():
    assert unique_names(["a", "A", "k"], reserved=["K"]) == ["a", "A_1", "payload_k"]


SHAPED = '{"id":7,"at":"2024-03-22T14:35:00Z","name":"x","in":{"v":1.5,"on":true},"list":[{"w":0.5,"s":"y"}]}'


@pytest.mark.parametrize(
    "others",
    [
        [],
        ['{"id":8,"at":"2024-03-22"}', '{"in":{"on":false}}', '{"list":[]}', '{"list":[null]}', "bad", None, "[1]", "{}"],
        ['{"at":"2024-02-31"}'],
        ['{"at":5}', '{"name":"2024-03-22"}'],
        ['{"in":{"v":"NaN"}}', '{"list":[{"w":"Infinity"}]}'],
        ['{"in":{"v":NaN}}', '{"id":2.0}', '{"list":[{"w":3}]}'],
        ['{"id":12345678901234567890}', '{"in":{"v":1234567890123456789012345}}'],
        ['{"id":"7"}', '{"name":7}', '{"in":{"on":"true"}}'],
        ['{"in":5}', '{"list":{"w":1}}', '{"at":{"b":1}}'],
        ['{"new":"2024-03-22"}', '{"in":{"new":null}}', '{"list":[{"new":[1]}]}'],
        ['{"id":1,"id":"x"}', '{"id":1} tail', '{"name":"\\u0041","at":"2024\\u002d03-22"}', '{ "at" : "2024-03-22" }'],
        ['{"at":"2024-03-22T14:35:00Z\\n"}', "{'name':1}", SHAPED[:-1]],
    ],
)
def test_schema_by_shape_is_the_schema_by_types(wide, others):
    messages = wide(SHAPED, *others, *[SHAPED] * 8).coalesce(1)
    assert _first_shape(messages, "json_string")[0] == SHAPED
    assert counted_recursive_schema(messages, by_shape=True) == counted_recursive_schema(messages)


def test_no_shape_of_texts_that_leave_types_open(wide):
    texts = ['{"a":null}', '{"a":2.0}', '{"a":[]}', '{"a":{}}', '{"a":[1,2.5]}', '{"a":1,"a":2}', '{"a":1,"A":2}', '{"a":NaN}']
    texts += ['{"a": 1}', "[1]", "bad", None, "", "[" * 5000]
    for text in texts:
        messages = wide(text, '{"a":"2024-03-22"}').coalesce(1)
        assert _first_shape(messages, "json_string")[0] == '{"a":"2024-03-22"}'
        assert counted_recursive_schema(messages, by_shape=True) == counted_recursive_schema(messages)


def test_no_shape_of_mixed_texts(wide):
    assert _first_shape(wide('{"a":1}', '{"a":"x"}', '{"b":1}').coalesce(1), "json_string") is None
    assert _first_shape(wide().coalesce(1), "json_string") is None


def test_texts_of_one_shape_are_parsed_once_to_infer(wide, monkeypatch):
    """Neither a pass of its own for the timestamps nor a document per text: only for those that differ from the shape."""
    seen = []

    def aggregates(rows, columns, in_one_job):
        seen.append(rows.where("document IS NOT NULL").count())
        return _aggregates(rows, columns, in_one_job)

    monkeypatch.setattr(inference, "_aggregates", aggregates)
    monkeypatch.setattr(inference, "is_iso_timestamp", lambda value: seen.append("tested") or is_iso_timestamp(value))
    messages = wide(*[SHAPED.replace("7", str(i)) for i in range(50)], '{"at":null}').coalesce(1)
    schema = recursive_schema(messages)
    assert schema["at"].dataType.simpleString() == "timestamp"
    # The witness and the odd one out; one test, in the same pass.
    assert seen == ["tested", 2]
