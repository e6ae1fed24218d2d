"""Flattening a payload next to envelope columns, and moving columns between schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timestamps import utc_text


def unique_names(names: Iterable[str], reserved: Iterable[str] = ()) -> list[str]:
    """Output names that differ in more than case, from each other and from the reserved ones.

    A name taken by the envelope gets the prefix ``payload_``; of names that differ only in case
    the later ones get a number.
    """
    taken = {name.lower() for name in reserved}
    result = []
    for name in names:
        while name.lower() in {r.lower() for r in reserved}:
            name = f"payload_{name}"
        unique, number = name, 0
        while unique.lower() in taken:
            number += 1
            unique = f"{name}_{number}"
        taken.add(unique.lower())
        result.append(unique)
    return result


def writable(data_type: T.DataType, reserved: Iterable[str] = ()) -> T.DataType:
    """The same type with struct field names that a case-insensitive reader can tell apart."""
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(writable(data_type.elementType))
    if isinstance(data_type, T.StructType):
        names = unique_names(data_type.names, reserved)
        fields = zip(names, data_type.fields, strict=True)
        return T.StructType([T.StructField(name, writable(f.dataType)) for name, f in fields])
    return data_type


def payload_fields(payload: Column, schema: T.StructType, reserved: Iterable[str] = ()) -> list[Column]:
    """The payload's fields as columns, renamed where they would collide."""
    target = writable(schema, reserved)
    return [
        payload.getField(source.name).cast(field.dataType).alias(field.name)
        for source, field in zip(schema.fields, target.fields, strict=True)
    ]


def align(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """A column of a narrower schema in the shape of a wider one (see ``merge_schemas``)."""
    if source == target:
        return column
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        known = {field.name: field.dataType for field in source.fields}
        fields = [
            align(column.getField(f.name), known[f.name], f.dataType).alias(f.name)
            if f.name in known
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return F.transform(column, lambda item: align(item, source.elementType, target.elementType))
    if isinstance(target, T.StringType) and isinstance(source, (T.StructType, T.ArrayType)):
        return F.to_json(column)
    if isinstance(target, T.StringType) and isinstance(source, T.TimestampType):
        return utc_text(column)
    return column.try_cast(target)
