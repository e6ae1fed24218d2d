"""Typed reads of one JSON value: forced into a type, or replaced by a default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .json_fields import json_type

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


# Type names of integers beyond 64 bits, which a variant holds as a decimal without scale.
_BIG_INTEGER = r"^DECIMAL\((19|[23]\d),0\)$"


def _value(node: Column, spark_type: str) -> Column:
    return F.try_variant_get(node, "$", spark_type)


def _low_bits(value: Column) -> Column:
    return F.shiftright(F.shiftleft(value, 32), 32).cast("int")


def as_int(node: Column, kind: Column | None = None) -> Column:
    """Force any JSON value into an int.

    Integers keep their low 32 bits; other numbers are truncated and stop at the int bounds; text is
    read as a number where it is one; true is 1; everything else is 0.

    Here and below, ``kind`` is ``json_type(node)``; pass it as a column that exists already and the
    type is determined once.
    """
    kind = json_type(node) if kind is None else kind
    big = F.pmod(_value(node, "decimal(38,0)"), F.lit(2**32).cast("decimal(38,0)")).cast("bigint")
    whole_text = (kind == "STRING") & _value(node, "string").rlike(r"^\s*[+-]?\d+\s*$")
    # NULL for what is no number; the expression is kept small so that the generated code is compiled.
    number = F.coalesce(F.nanvl(_value(node, "double"), F.lit(0.0)), F.lit(0.0))
    return (
        F.when(kind == "BIGINT", _low_bits(_value(node, "bigint")))
        .when(whole_text, F.coalesce(_value(node, "int"), F.lit(0)))
        .when(kind.rlike(_BIG_INTEGER), _low_bits(big))
        .when(kind.isNotNull(), F.greatest(F.least(number, F.lit(float(INT_MAX))), F.lit(float(INT_MIN))).cast("int"))
    )


def as_text(node: Column, kind: Column | None = None) -> Column:
    """Force any JSON value into text; objects and arrays give the empty text, null gives 'null'."""
    kind = json_type(node) if kind is None else kind
    return (
        F.when(kind.isin("STRING", "BIGINT", "BOOLEAN", "DOUBLE"), _value(node, "string"))
        .when(kind == "VOID", F.lit("null"))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(""))
        .when(kind.rlike(_BIG_INTEGER), _value(node, "string"))
        .otherwise(_value(node, "double").cast("string"))
    )


def int_or_default(node: Column, kind: Column | None = None, default: int = -1) -> Column:
    """The value if it is an integer within 32 bits, else the default (2.0, "2" and true are not)."""
    kind = json_type(node) if kind is None else kind
    # A failed read gives NULL, which is not an int, so the read alone covers the bounds.
    fits = F.when(kind == "BIGINT", _value(node, "int"))
    return F.coalesce(fits, F.lit(default))


def text_or_default(node: Column, kind: Column | None = None, default: str = "Unknown") -> Column:
    """The value if it is JSON text, else the default."""
    kind = json_type(node) if kind is None else kind
    return F.when(kind == "STRING", _value(node, "string")).otherwise(F.lit(default))
