"""Parse policies: how a message text becomes a row, and what happens to texts that do not fit.

All of them are narrow DataFrame -> DataFrame steps without a shuffle, for batch and stream alike.
The parse sits in its own projection and rows are kept or dropped by ``inline`` (``_rows_of``). A
filter on the parsed column would be pushed below the projection and parse each text again for every
condition.

``keep`` names the input columns that stay next to the parsed fields. With ``counter`` the policy
adds observed counts (seen, kept, skipped) under that name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import as_int, as_text, int_or_default, text_or_default
from ..functions.json_fields import has_fields, json_type, keep_repeated_keys, open_document
from ..functions.timestamps import as_utc_timestamp
from ..sources.envelope import NARROW, ORIGIN
from .inference import OBJECT_TOKENS
from .shape import payload_fields, writable

# Schemas with fixed field names and types.
USER = T.StructType().add("id", "integer").add("name", "string").add("age", "integer")
PRODUCT = (
    T.StructType().add("id", "integer").add("product", "string").add("price", "double").add("in_stock", "boolean")
)
FALLBACK_EVENT = T.StructType().add("id", "string").add("timestamp", "string").add("payload", "string")

CORRUPT = "_corrupt_record"

# Field name -> function of the JSON value and its type.
FieldReaders = Mapping[str, Callable[[Column, Column], Column]]
USER_COERCED: FieldReaders = {"id": as_int, "name": as_text, "age": as_int}
USER_DEFAULTED: FieldReaders = {"id": int_or_default, "name": text_or_default, "age": int_or_default}


def _rows_of(rows: DataFrame, keep: Sequence[str], record: Column) -> DataFrame:
    """The fields of a struct column, for the rows where it is not null.

    The struct is computed in a projection, which shares its common parts, before the generator.
    """
    records = rows.select(*keep, record.alias("_record"))
    return records.select(*keep, F.inline(F.when(F.col("_record").isNotNull(), F.array("_record"))))


def _opened(messages: DataFrame, fields: FieldReaders, keep: Sequence[str], counter: str | None):
    keep_repeated_keys(messages.sparkSession)
    opened = messages.select(*keep, open_document(F.col("json_string"), fields).alias("_document"))
    document, kinds = F.col("_document"), F.col("_kinds")
    complete = has_fields(document, fields)
    opened = opened.withColumn(
        "_kinds", F.struct(*[json_type(document.getField(name)).alias(name) for name in fields])
    )
    if counter:
        opened = opened.observe(
            counter,
            F.count(F.lit(1)).alias("seen"),
            F.count_if(complete).alias("kept"),
            F.count_if(~complete).alias("skipped"),
        )
    values = [read(document.getField(name), kinds.getField(name)).alias(name) for name, read in fields.items()]
    record = F.struct(*values)
    return opened, complete, record


def strict_records(
    messages: DataFrame, fields: FieldReaders = USER_COERCED, *, keep: Sequence[str] = (), counter: str | None = None
) -> DataFrame:
    """One record per message, values forced into their types; fails on a message without a field."""
    opened, complete, record = _opened(messages, fields, keep, counter)
    where = [F.concat(F.lit(f", {name} "), F.col(name).cast("string")) for name in keep if name in ORIGIN[3:]]
    text = F.concat(F.lit(f"message is not a JSON object with the fields {', '.join(fields)}"), *where)
    return _rows_of(opened, keep, F.when(complete, record).otherwise(F.raise_error(text)))


def lenient_records(
    messages: DataFrame, fields: FieldReaders = USER_DEFAULTED, *, keep: Sequence[str] = (), counter: str | None = None
) -> DataFrame:
    """Records of the messages that have every field; wrong types become defaults, the rest is skipped."""
    opened, complete, record = _opened(messages, fields, keep, counter)
    return _rows_of(opened, keep, F.when(complete, record))


def fixed_schema_rows(messages: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    """One row per message under a given schema; texts and values that do not fit give nulls."""
    parsed = messages.select(*keep, F.from_json("json_string", schema).alias("_data"))
    return parsed.select(*keep, *payload_fields(F.col("_data"), schema, keep))


def _with_capture(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def parse_with_capture(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds ``parsed_data``: the fields of the schema and the text of a message that did not fit.

    Feeds ``good_rows``, ``bad_rows`` and ``split_counts``; persist it where all of them are wanted.
    """
    options = {"columnNameOfCorruptRecord": CORRUPT}
    return messages.withColumn("parsed_data", F.from_json("json_string", _with_capture(schema), options))


def _is_bad() -> Column:
    # An empty text has neither fields nor a corrupt text, so both signs count.
    parsed = F.col("parsed_data")
    return parsed.isNull() | parsed.getField(CORRUPT).isNotNull()


def _payload_schema(parsed: DataFrame) -> T.StructType:
    fields = parsed.schema["parsed_data"].dataType.fields
    return T.StructType([field for field in fields if field.name != CORRUPT])


def good_rows(parsed: DataFrame, keep: Sequence[str] = (NARROW[0], NARROW[2])) -> DataFrame:
    """Messages that fit the schema, flattened next to the envelope."""
    fields = payload_fields(F.col("parsed_data"), _payload_schema(parsed), keep)
    return _rows_of(parsed, keep, F.when(~_is_bad(), F.struct(*fields)))


def bad_rows(parsed: DataFrame, keep: Sequence[str] = NARROW) -> DataFrame:
    """Messages that did not: envelope, text, the fields that could be read, the captured text."""
    payload = F.col("parsed_data")
    fields = payload_fields(payload, _payload_schema(parsed))
    row = F.struct(F.struct(*fields).alias("parsed_data"), payload.getField(CORRUPT).alias("corrupt_record"))
    return _rows_of(parsed, keep, F.when(_is_bad(), row))


def split_measures() -> list[Column]:
    """The counts of both sides, to aggregate or to observe."""
    return [F.count(F.lit(1)).alias("seen"), F.count_if(~_is_bad()).alias("good"), F.count_if(_is_bad()).alias("bad")]


def split_counts(parsed: DataFrame) -> DataFrame:
    return parsed.agg(*split_measures())


def captured_rows(messages: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    """Every message as a row: the fields that fit, and ``_corrupt_record`` where not all did.

    A text without any object, such as a blank one or ``[]``, stands in ``_corrupt_record`` as well; a message without a
    value is a null row.
    """
    parsed = parse_with_capture(messages.select(*keep, "json_string"), schema)
    payload = F.col("parsed_data")
    fields = payload_fields(payload, schema, (*keep, CORRUPT))
    nothing = F.when(payload.isNull(), F.col("json_string"))
    return parsed.select(*keep, *fields, F.coalesce(payload.getField(CORRUPT), nothing).alias(CORRUPT))


def array_rows(messages: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    """A row per element of a top-level array, one row for a single object, a null row otherwise.

    An array without elements gives a null row too, so every message has at least one row.
    """
    return _element_rows(messages, schema, keep).drop(CORRUPT)


def inferred_rows(messages: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ORIGIN) -> DataFrame:
    """Rows under an inferred schema, each with the envelope of its own message.

    Arrays of objects give a row per element. A text that is no object, and an array without elements, keeps
    its envelope and stands in ``_corrupt_record``; a message without a value is a null row.
    """
    return _element_rows(messages, schema, keep)


def _element_rows(messages: DataFrame, schema: T.StructType, keep: Sequence[str]) -> DataFrame:
    if not schema.fields:
        # Something to parse for, to tell objects without fields from other texts.
        nothing = T.StructType().add("_nothing", "string")
        return _element_rows(messages, nothing, keep).drop("_nothing")
    text = F.col("json_string")
    renamed = T.ArrayType(writable(schema, (*keep, CORRUPT)))
    elements = F.from_json(text, T.ArrayType(schema)).cast(renamed)
    parsed = messages.select(*keep, "json_string", elements.alias("_elements"))
    missing = F.col("_elements").isNull() | (F.size("_elements") == 0)
    one_null_row = F.array(F.lit(None).cast(renamed.elementType))
    return parsed.select(
        *keep,
        F.when(missing, text).alias(CORRUPT),
        F.inline(F.when(missing, one_null_row).otherwise(F.col("_elements"))),
    )


def _text_schema(data_type: T.DataType) -> T.DataType:
    """The schema to parse with: timestamps are read as text first."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _text_schema(f.dataType)) for f in data_type.fields])
    return T.StringType() if isinstance(data_type, T.TimestampType) else data_type


def _convert(node: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return as_utc_timestamp(node)
    if isinstance(data_type, T.StructType):
        fields = [_convert(node.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(node.isNotNull(), F.struct(*fields))
    return node


def _lost(text: Column, converted: Column, data_type: T.DataType) -> Column:
    """True where a text was present but is not the timestamp its field asks for."""
    if isinstance(data_type, T.TimestampType):
        return text.isNotNull() & converted.isNull()
    lost = F.lit(False)
    if isinstance(data_type, T.StructType):
        for field in data_type.fields:
            lost = lost | _lost(text.getField(field.name), converted.getField(field.name), field.dataType)
    return lost


def parse_converted(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds ``_data``, the fields in their final types, and ``_fits``, which tells the messages that fit the schema.

    Feeds ``converted_of``, ``rejected_of`` and ``conversion_counts``; persist it where several of them are wanted. Nothing
    fits a schema without fields.
    """
    if not schema.fields:
        return messages.withColumns({"_data": F.struct(F.lit(None).alias("_nothing")), "_fits": F.lit(False)})
    text_schema = _with_capture(_text_schema(schema))
    options = {"columnNameOfCorruptRecord": CORRUPT, **OBJECT_TOKENS}
    parsed = messages.withColumn("_text", F.from_json("json_string", text_schema, options))
    text = F.col("_text")
    converted = parsed.withColumn("_data", _convert(text, schema))
    lost = _lost(text, F.col("_data"), schema)
    fits = text.isNotNull() & text.getField(CORRUPT).isNull() & ~lost
    return converted.select(*messages.columns, "_data", fits.alias("_fits"))


def converted_of(parsed: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    if not schema.fields:
        return parsed.select(*keep).filter(F.lit(False))
    return _rows_of(parsed, keep, F.when(F.col("_fits"), F.col("_data").cast(writable(schema, keep))))


def rejected_of(parsed: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    return _rows_of(parsed, (*keep, "json_string"), F.when(~F.col("_fits"), F.struct(F.lit(True).alias("_rejected")))).drop(
        "_rejected"
    )


def conversion_measures() -> list[Column]:
    """The counts of both sides, to aggregate or to observe."""
    fits = F.col("_fits")
    return [F.count(F.lit(1)).alias("seen"), F.count_if(fits).alias("kept"), F.count_if(~fits).alias("rejected")]


def converted_rows(messages: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    """JSON objects projected by name onto a schema of ``recursive_schema``, texts to UTC timestamps.

    Absent fields are null, unknown ones are dropped; what is no object, or holds a value its field
    cannot take, is left to ``rejected_rows``.
    """
    return converted_of(parse_converted(messages.select(*keep, "json_string"), schema), schema, keep=keep)


def rejected_rows(messages: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    """The messages ``converted_rows`` leaves out, as text; all of them under a schema without fields."""
    if not schema.fields:
        return messages.select(*keep, "json_string")
    return rejected_of(parse_converted(messages.select(*keep, "json_string"), schema), keep=keep)
