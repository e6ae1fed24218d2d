"""Access to the fields of a JSON text that keeps absent, null and wrong type apart.

``from_json`` with VARIANT fields reads only the named fields, in one pass over the text. A field
that is absent is NULL, an explicit JSON null is a VOID variant, and any other value keeps its own
JSON type, so the policies can tell the three apart. Of repeated keys the last one wins, text after
the first value is ignored. For keys repeated inside a named field that takes a session setting, which is read when a
query starts: the policies turn it on and leave it on (``keep_repeated_keys``).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "_malformed"

# Plain JSON: the relaxations that from_json has on by default are switched off.
PLAIN_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def keep_repeated_keys(spark: SparkSession) -> None:
    """Lets a variant keep the last of repeated keys, as parsing under a schema does.

    The setting stays on for the session: turning it off again would reach into queries of other threads, and streams
    read it when they start.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def open_document(json: Column, fields: Iterable[str]) -> Column:
    """Struct with one VARIANT per named field, plus the text itself if it is not an object."""
    schema = T.StructType([T.StructField(name, T.VariantType()) for name in fields])
    schema = schema.add(MALFORMED, T.StringType())
    return F.from_json(json, schema, {**PLAIN_JSON, "columnNameOfCorruptRecord": MALFORMED})


def has_fields(document: Column, fields: Iterable[str]) -> Column:
    """True if the text was an object that holds every named field (a JSON null counts)."""
    present = [document.getField(name).isNotNull() for name in fields]
    return reduce(Column.__and__, present, document.getField(MALFORMED).isNull() & document.isNotNull())


def json_type(node: Column) -> Column:
    """Type name of a VARIANT: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>."""
    return F.schema_of_variant(node)
