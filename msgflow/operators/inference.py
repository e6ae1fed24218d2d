"""Schemas from JSON: of one sample, of a whole batch, and with timestamp detection.

Every function here returns a ``StructType`` and reads a bounded DataFrame. The work is an
aggregation on the cluster; only the schema itself comes back to the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_fields import PLAIN_JSON, keep_repeated_keys
from ..functions.timestamps import ISO_FORM, is_iso_timestamp
from ..sources.files import literal_messages
from ..sources.sample import first_document, first_document_of_stream

# What a topic without a usable sample is parsed with.
DEFAULT_SCHEMA = T.StructType([T.StructField("data", T.StringType())])

# JSON with double quotes only; NaN and Infinity are numbers.
OBJECT_TOKENS = {"allowSingleQuotes": "false"}

# Where the shape of a document is looked for: so many messages, of so many characters at most.
_SHAPE_MESSAGES, _SHAPE_CHARACTERS = 20, 65_536

# An integer column that also saw 2.0, or one with integers beyond 64 bits: told apart later.
_UNSETTLED = T.DecimalType(20, 0)


def schema_of_sample(spark: SparkSession, text: str) -> T.StructType | None:
    """Schema of one JSON text; of the elements for an array of objects; None for anything else."""
    schema = batch_schema(literal_messages(spark, [text]))
    return schema if schema.fields else None


def sample_schema(wide: DataFrame, checkpoint: str | None = None) -> T.StructType:
    """Schema of the first JSON object of a wide envelope, else the default schema.

    A streaming envelope is read in its bounded micro-batches until there is one; that takes a ``checkpoint``.
    """
    text = first_document_of_stream(wide, checkpoint) if wide.isStreaming else first_document(wide)
    schema = None if text is None else schema_of_sample(wide.sparkSession, text)
    return schema or DEFAULT_SCHEMA


def batch_schema(messages: DataFrame, column: str = "json_string") -> T.StructType:
    """Schema of all JSON objects in a column, widened over the rows.

    Arrays of objects count as their elements. int and double give double, all other conflicts
    give string, and so do fields that were null everywhere; an empty text is a text. Empty if no row
    holds an object with a field.
    """
    return counted_batch_schema(messages, column)[1]


def _aggregates(rows: DataFrame, columns: Sequence[Column], in_one_job: bool) -> list:
    """The values of aggregate columns. In one job, they are observed: every task sends its part to the driver, without a shuffle."""
    named = [column.alias(f"a{i}") for i, column in enumerate(columns)]
    if not in_one_job:
        return list(rows.agg(*named).first())
    observation = Observation()
    rows.observe(observation, *named).write.format("noop").mode("overwrite").save()
    return [observation.get[f"a{i}"] for i in range(len(named))]


def counted_batch_schema(
    messages: DataFrame, column: str = "json_string", *, in_one_job: bool = False
) -> tuple[int, T.StructType]:
    """The number of rows, and their ``batch_schema``; ``in_one_job`` is fit for batches of bounded size."""

    def values(asked: list[tuple[str, ...]]) -> DataFrame:
        parsed = messages.select(F.from_json(column, _only(schema, set(asked))).alias("document"))
        return parsed.select(*[reduce(Column.getField, path, F.col("document")) for path in asked])

    n, schema = _widened(messages, column, in_one_job)
    return n, _settled(schema, [], values)


def recursive_schema(messages: DataFrame, column: str = "json_string", *, persist: bool = False) -> T.StructType:
    """``batch_schema`` of the objects alone, with ISO-8601 text fields as timestamps.

    A text field, at any depth of nested objects, becomes a timestamp if every value it has in the
    batch is an ISO date or date and time. With ``persist`` the parsed documents are kept between the two
    aggregations, so each text is parsed once; fit for batches of bounded size. Without it the texts are compared with the
    shape of one of the first documents, and only those that differ from it are looked at type by type.
    """
    return counted_recursive_schema(messages, column, persist=persist, by_shape=not persist)[1]


def counted_recursive_schema(
    messages: DataFrame,
    column: str = "json_string",
    *,
    persist: bool = False,
    known: T.StructType | None = None,
    in_one_job: bool = False,
    by_shape: bool = False,
) -> tuple[int, T.StructType]:
    """The number of rows, and their ``recursive_schema``, in one aggregation where that is possible, else in two.

    ``known`` is a schema that the result is merged with afterwards: what is text there stays text, so it is not looked at, and
    what is a timestamp there is tested together with the inference. ``by_shape``, without ``known``, is for many messages that
    are cheap to read from the start: it looks at the first ones beforehand.
    """
    text = F.when(lead_character(column) == "{", F.col(column))
    documents = messages.select(
        text.alias("text"), F.from_json(text, T.VariantType(), dict(OBJECT_TOKENS)).alias("document")
    )
    documents = documents.persist() if persist else documents
    kinds = dict(leaves(known)) if known is not None else {}
    guesses = [path for path, leaf in kinds.items() if leaf == T.TimestampType()]
    shaped = _first_shape(messages, column) if by_shape and known is None else None
    try:
        keep_repeated_keys(messages.sparkSession)
        if shaped is None:
            looked_at = documents.withColumns({"counted": F.lit(True), **{f"g{i}": _leaf(p) for i, p in enumerate(guesses)}})
        else:
            guesses = _not_refuted([path for path, leaf in leaves(shaped[1]) if leaf == T.StringType()], shaped[0])
            looked_at = _compared(messages.select(text.alias("text")), *shaped, guesses)
        tests = [n for i in range(len(guesses)) for n in _timestamp_counts(F.col(f"g{i}"))]
        wanted = [F.count_if("counted"), F.schema_of_variant_agg("document"), F.first("text", ignorenulls=True), *tests]
        n, objects, witness, *counts = _aggregates(looked_at, wanted, in_one_job)
        schema = _from_variant_schema(objects)
        schema = schema if isinstance(schema, T.StructType) else T.StructType()
        texts = [path for path, leaf in leaves(schema) if leaf == T.StringType() and kinds.get(path) != T.StringType()]
        tested = dict(zip(guesses, zip(counts[::2], counts[1::2], strict=True), strict=True))
        stamps = [path for path in texts if path in tested and tested[path][0] and not tested[path][1]]
        schema = _replace(schema, dict.fromkeys(stamps, T.TimestampType()))
        open_texts = _not_refuted([path for path in texts if path not in tested], witness)
        open_texts = _not_refuted(open_texts, shaped[0]) if shaped is not None else open_texts
        return n, _settled(schema, open_texts, lambda asked: documents.select(*[_leaf(path) for path in asked]))
    finally:
        if persist:
            documents.unpersist()


def _first_shape(messages: DataFrame, column: str) -> tuple[str, T.StructType] | None:
    """One of the first texts, and the types of its fields in their order; None unless half of the texts there have that shape."""
    short = F.when(F.length(column) <= _SHAPE_CHARACTERS, F.col(column))
    first = messages.select(short).limit(_SHAPE_MESSAGES).collect()
    found: list[tuple[str, T.StructType]] = []
    for (text,) in first:
        try:
            document = json.loads(text or "", object_pairs_hook=_fields_once, parse_constant=_no_number)
            if isinstance(document, dict) and json.dumps(document, ensure_ascii=False, separators=(",", ":")) == text:
                shape = _shape(document)
                if shape is not None:
                    found.append((text, shape))
        except (ValueError, RecursionError):
            continue
    shapes = [shape for _, shape in found]
    return next((pair for pair in found if 2 * shapes.count(pair[1]) >= len(first)), None)


def _fields_once(pairs: list[tuple[str, object]]) -> dict:
    fields = dict(pairs)
    if len({name.lower() for name in fields}) < len(pairs):
        raise ValueError("names that are the same, or differ only in case")
    return fields


def _no_number(name: str) -> None:
    raise ValueError(name)


def _shape(value: object) -> T.DataType | None:
    """The type of a JSON value; None for values that leave it open, such as null, an empty list, or 2.0."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, str):
        return T.StringType()
    if isinstance(value, int):
        return T.LongType() if -(2**63) <= value < 2**63 else None
    if isinstance(value, float):
        return T.DoubleType() if value % 1 > 0 else None
    if isinstance(value, list):
        elements = [_shape(element) for element in value]
        same = bool(elements) and all(element == elements[0] for element in elements)
        return T.ArrayType(elements[0]) if same and elements[0] is not None else None
    if isinstance(value, dict):
        types = {name: _shape(inner) for name, inner in value.items()}
        known = bool(types) and all(inner is not None for inner in types.values())
        return T.StructType([T.StructField(name, inner) for name, inner in types.items()]) if known else None
    return None


def _compared(texts: DataFrame, witness: str, shape: T.StructType, guesses: list[tuple[str, ...]]) -> DataFrame:
    """The texts with a document only where it can add to the schema of the witness; ``g0`` ... are the values of the guesses.

    A text that is the same after it was read under the shape and written again has the fields and types of the shape and
    no others. The witness itself is added as a row that does not count.
    """
    added = texts.sparkSession.range(1, numPartitions=1).select(F.lit(witness).alias("text"), F.lit(False).alias("counted"))
    rows = added.union(texts.select("text", F.lit(True)))
    # NaN and infinity as text would pass for numbers otherwise.
    rows = rows.withColumn("typed", F.from_json("text", shape, dict(PLAIN_JSON)))
    same = F.coalesce(F.col("counted") & (F.to_json("typed") == F.col("text")), F.lit(False))
    known = [reduce(Column.getField, path, F.col("typed")).alias(f"t{i}") for i, path in enumerate(guesses)]
    rows = rows.select("text", "counted", same.alias("same"), *known)
    other = F.from_json(F.when(~F.col("same"), F.col("text")), T.VariantType(), dict(OBJECT_TOKENS))
    rows = rows.withColumn("document", other)
    # The witness is a message as well, so its values are looked at with that.
    counted = F.when(F.col("counted"), F.lit(True))
    values = [
        F.when(F.col("same"), F.col(f"t{i}")).when(counted, _leaf(path)).alias(f"g{i}") for i, path in enumerate(guesses)
    ]
    return rows.select("text", "counted", "document", *values)


def _timestamp_counts(value: Column) -> tuple[Column, Column]:
    """How many values there are, and how many of them are no timestamps."""
    return F.count(value), F.count_if(value.isNotNull() & ~is_iso_timestamp(value))


def _leaf(path: tuple[str, ...]) -> Column:
    """The value at a path of a document as text; a JSON null is null."""
    if any('"' in name and "'" in name for name in path):
        # A variant's path has no way to write such a name, so the text is parsed for it.
        schema = reduce(lambda inner, name: T.StructType().add(name, inner), reversed(path), T.StringType())
        return reduce(Column.getField, path, F.from_json("text", schema, dict(OBJECT_TOKENS)))
    quoted = [f"['{name}']" if '"' in name else f'["{name}"]' for name in path]
    return F.try_variant_get("document", "$" + "".join(quoted), "string")


def merge_schemas(first: T.DataType, second: T.DataType, *, exact: bool = False) -> T.DataType:
    """The narrowest type both fit in: fields of both, int -> decimal -> double -> string.

    With ``exact`` integers and doubles meet in string, since a double does not hold every integer.
    """
    if first == second:
        return first
    if isinstance(first, T.StructType) and isinstance(second, T.StructType):
        other = {field.name: field.dataType for field in second.fields}
        fields = [
            T.StructField(f.name, merge_schemas(f.dataType, other.pop(f.name, f.dataType), exact=exact))
            for f in first.fields
        ]
        fields += [T.StructField(name, data_type) for name, data_type in other.items()]
        return T.StructType(fields)
    if isinstance(first, T.ArrayType) and isinstance(second, T.ArrayType):
        return T.ArrayType(merge_schemas(first.elementType, second.elementType, exact=exact))
    numbers = (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType)
    if isinstance(first, numbers) and isinstance(second, numbers):
        if isinstance(first, T.DoubleType) or isinstance(second, T.DoubleType):
            return T.StringType() if exact else T.DoubleType()
        decimals = [t.precision for t in (first, second) if isinstance(t, T.DecimalType)]
        return T.DecimalType(max(decimals), 0) if decimals else T.LongType()
    return T.StringType()


def lead_character(column: str) -> Column:
    """The first character that is no white space: tells objects and arrays apart without parsing."""
    return F.ltrim(F.col(column), F.lit(" \t\r\n")).substr(1, 1)


def _widened(messages: DataFrame, column: str, in_one_job: bool) -> tuple[int, T.StructType]:
    documents = messages.select(lead_character(column).alias("lead"), F.from_json(column, T.VariantType()).alias("document"))
    document = F.col("document")
    is_object = F.col("lead") == "{"
    is_rows = (F.col("lead") == "[") & F.schema_of_variant(document).startswith("ARRAY<OBJECT<")
    keep_repeated_keys(messages.sparkSession)
    wanted = [
        F.count(F.lit(1)),
        F.schema_of_variant_agg(F.when(is_object, document)),
        F.schema_of_variant_agg(F.when(is_rows, document)),
    ]
    n, objects, elements = _aggregates(documents, wanted, in_one_job)
    schema = _from_variant_schema(objects)
    rows = _from_variant_schema(elements)
    if isinstance(rows, T.ArrayType):
        rows = rows.elementType
    if isinstance(rows, T.StructType):
        schema = merge_schemas(schema, rows) if isinstance(schema, T.StructType) else rows
    return n, schema if isinstance(schema, T.StructType) else T.StructType()


def _not_refuted(paths: list[tuple[str, ...]], witness: str | None) -> list[tuple[str, ...]]:
    """The paths that are not shown to hold other texts than timestamps by this one object."""
    try:
        document = json.loads(witness or "")
    except ValueError:
        return paths

    def refuted(path: tuple[str, ...]) -> bool:
        node = document
        for name in path:
            node = node.get(name) if isinstance(node, dict) else None
        return isinstance(node, str) and re.match(ISO_FORM, node, re.ASCII) is None

    return [path for path in paths if not refuted(path)]


def _from_variant_schema(text: str | None) -> T.DataType | None:
    return None if text is None else _storable(variant_type(text))


def variant_type(text: str) -> T.DataType:
    """The type that ``schema_of_variant`` names."""
    # Names stand in backticks where they are not plain, so only the parts outside count.
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    parts[::2] = [part.replace("OBJECT<", "STRUCT<") for part in parts[::2]]
    return T.DataType.fromDDL("".join(parts))


def _storable(data_type: T.DataType) -> T.DataType | None:
    """Types a Parquet column can have; None for objects that never had a field, and lists of such."""
    if isinstance(data_type, T.StructType):
        fields = [(field.name, _storable(field.dataType)) for field in data_type.fields]
        fields = [T.StructField(name, kept) for name, kept in fields if kept is not None]
        return T.StructType(fields) if fields else None
    if isinstance(data_type, T.ArrayType):
        element = _storable(data_type.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(data_type, T.DecimalType):
        whole = data_type.scale == 0 and data_type.precision >= _UNSETTLED.precision
        return data_type if whole else T.DoubleType()
    if isinstance(data_type, (T.VariantType, T.NullType)):
        return T.StringType()
    return data_type


def leaves(data_type: T.DataType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    if isinstance(data_type, T.StructType):
        for field in data_type.fields:
            yield from leaves(field.dataType, (*path, field.name))
    else:
        yield path, data_type


def _replace(schema: T.StructType, types: dict[tuple[str, ...], T.DataType], path=()) -> T.StructType:
    fields = []
    for field in schema.fields:
        here = (*path, field.name)
        data_type = field.dataType
        if isinstance(data_type, T.StructType):
            data_type = _replace(data_type, types, here)
        fields.append(T.StructField(field.name, types.get(here, data_type)))
    return T.StructType(fields)


def _only(schema: T.StructType, paths: set[tuple[str, ...]], path=()) -> T.StructType:
    """The schema without the leaves that are not asked for, the others as text."""
    fields = []
    for field in schema.fields:
        here = (*path, field.name)
        if here in paths:
            fields.append(T.StructField(field.name, T.StringType()))
        elif isinstance(field.dataType, T.StructType):
            inner = _only(field.dataType, paths, here)
            if inner.fields:
                fields.append(T.StructField(field.name, inner))
    return T.StructType(fields)


def _settled(
    schema: T.StructType,
    texts: list[tuple[str, ...]],
    values: Callable[[list[tuple[str, ...]]], DataFrame],
) -> T.StructType:
    """Decide the leaves whose type depends on the texts of their values, in one aggregation.

    These are the given text leaves, and integers of 20 digits that may have been 2.0 somewhere. ``values`` gives their
    values as text, a column each; without any there is no pass over the data.
    """
    decimals = [path for path, leaf in leaves(schema) if leaf == _UNSETTLED]
    if not decimals and not texts:
        return schema
    rows = values([*decimals, *texts])
    rows = rows.toDF(*[f"v{i}" for i in range(len(rows.columns))])
    value = [F.col(name) for name in rows.columns]
    fractions = [F.count_if(v.rlike("[.eE]")) for v in value[: len(decimals)]]
    seen, other = zip(*map(_timestamp_counts, value[len(decimals) :])) if texts else ((), ())
    found = list(rows.agg(*[n.alias(f"n{i}") for i, n in enumerate((*fractions, *seen, *other))]).first())
    settled: dict[tuple[str, ...], T.DataType] = {}
    for path, fraction in zip(decimals, found[: len(decimals)], strict=True):
        if fraction:
            settled[path] = T.DoubleType()
    seen_counts = found[len(decimals) : len(decimals) + len(texts)]
    for path, count, mismatches in zip(texts, seen_counts, found[len(decimals) + len(texts) :], strict=True):
        if count and not mismatches:
            settled[path] = T.TimestampType()
    return _replace(schema, settled)
