"""Summaries of messages from which their schema follows, and that can be added up over batches.

A summary counts, for every path of nested objects, the kinds of value that stand there: the type as a variant names it, with texts split into ISO
timestamps and others. A made-up value of each kind stands for all values of it, so the schema of any number of batches is that of a handful of
such values, found by the same inference as over all messages; and the paths on which kinds conflict come with their counts.
No value of a message is kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_fields import keep_repeated_keys
from ..functions.timestamps import is_iso_timestamp
from ..sources.files import literal_messages
from .inference import OBJECT_TOKENS, lead_character, recursive_schema, variant_type

SUMMARY = "path array<string>, kind string, messages bigint"


def _value(path: tuple[str, ...]) -> Column:
    """The variant at a path of a document; null where there is none."""
    if any('"' in name and "'" in name for name in path):
        # A variant's path has no way to write such a name, so the text is parsed for it.
        schema = reduce(lambda inner, name: T.StructType().add(name, inner), reversed(path), T.VariantType())
        return reduce(Column.getField, path, F.from_json("text", schema, dict(OBJECT_TOKENS)))
    quoted = [f"['{name}']" if '"' in name else f'["{name}"]' for name in path]
    return F.try_variant_get("document", "$" + "".join(quoted), "variant")


def _nodes(data_type: T.DataType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """All paths of nested objects, those of objects included, also of objects that never have a field."""
    for field in data_type.fields if isinstance(data_type, T.StructType) else ():
        yield (*path, field.name)
        yield from _nodes(field.dataType, (*path, field.name))


def schema_summary(messages: DataFrame, column: str = "json_string") -> DataFrame:
    """(path, kind, messages) of the JSON objects in a column. Texts that are no object count nowhere."""
    spark = messages.sparkSession
    keep_repeated_keys(spark)
    text = F.when(lead_character(column) == "{", F.col(column))
    documents = messages.select(text.alias("text"), F.from_json(text, T.VariantType(), dict(OBJECT_TOKENS)).alias("document"))
    shape = documents.agg(F.schema_of_variant_agg("document")).first()[0]
    paths = list(_nodes(variant_type(shape))) if shape is not None else []
    if not paths:
        return spark.createDataFrame([], SUMMARY)
    values = documents.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("number"), _value(path).alias("value")) for i, path in enumerate(paths)]))
    ).where("value is not null")
    shape = F.schema_of_variant("value")
    plain = F.try_variant_get("value", "$", "string")
    kind = (
        F.when(shape.startswith("OBJECT<"), "OBJECT")
        .when(shape == "STRING", F.when(is_iso_timestamp(plain), "TIMESTAMP").otherwise("STRING"))
        .otherwise(shape)
    )
    counted = values.groupBy("number", kind.alias("kind")).agg(F.count(F.lit(1)).alias("messages"))
    named = F.element_at(F.array(*[F.array(*[F.lit(name) for name in path]) for path in paths]), F.col("number") + 1)
    return counted.select(named.alias("path"), "kind", "messages")


def merged_summaries(summaries: DataFrame) -> DataFrame:
    """The summary of all batches together."""
    return summaries.groupBy("path", "kind").agg(F.sum("messages").alias("messages"))


def summarized_schema(spark: SparkSession, summaries: DataFrame) -> T.StructType:
    """The ``recursive_schema`` of all messages that the summaries count, from the summaries alone.

    The distinct kinds of all paths come to the driver, as the schema itself does.
    """
    found = summaries.select("path", "kind").distinct().collect()
    texts = [reduce(lambda inner, name: f"{{{json.dumps(name)}:{inner}}}", reversed(r["path"]), _example(r["kind"])) for r in found]
    return recursive_schema(literal_messages(spark, texts))


def _example(kind: str) -> str:
    """A JSON value of a kind."""
    if kind in ("OBJECT", "TIMESTAMP"):
        return "{}" if kind == "OBJECT" else '"2024-03-22"'
    return _example_of(variant_type(kind), 0)


def _example_of(data_type: T.DataType, other: int) -> str:
    """One of two JSON values that together have a type: a variant is a number in the first and a text in the second."""
    if isinstance(data_type, T.StructType):
        return "{" + ",".join(f"{json.dumps(f.name)}:{_example_of(f.dataType, other)}" for f in data_type.fields) + "}"
    if isinstance(data_type, T.ArrayType):
        return f"[{_example_of(data_type.elementType, 0)},{_example_of(data_type.elementType, 1)}]"
    if isinstance(data_type, T.DecimalType):
        whole, fraction = "9" * (data_type.precision - data_type.scale) or "0", "9" * data_type.scale
        # Only beyond 64 bits a number without a fraction is a decimal of its own accord.
        return f"{whole}.{fraction or 0}" if fraction or data_type.precision <= 18 else whole
    if isinstance(data_type, T.VariantType):
        return ("1", '"text"')[other]
    examples = {T.NullType: "null", T.BooleanType: "true", T.LongType: "1", T.DoubleType: "1.0E3", T.StringType: '"text"'}
    return examples[type(data_type)]


def schema_conflicts(summaries: DataFrame) -> DataFrame:
    """(path, kind, messages) of the paths on which more than one kind of value stands; nulls conflict with nothing."""
    merged = merged_summaries(summaries).where("kind <> 'VOID'")
    several = merged.groupBy("path").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("path")
    return merged.join(several, "path").select("path", "kind", "messages")
