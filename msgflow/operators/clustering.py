"""Rows close to each other in several columns into the same files, so that file statistics prune on any of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each column is cut into 2**RANK_BITS ranges with about as many rows each.
RANK_BITS = 6
#: Ranks of the borders are within this share of the rows.
_RANK_ERROR = 0.002
_ORDERED = (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)


def _number(rows: DataFrame, name: str) -> Column:
    kind = rows.schema[name].dataType
    if not isinstance(kind, _ORDERED):
        raise ValueError(f"{name} must be a number, date or timestamp, not {kind.simpleString()}")
    column = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampNTZType):
        column = F.convert_timezone(F.lit("UTC"), F.lit("UTC"), column).cast("timestamp")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return F.unix_micros(column.cast("timestamp")).cast("double") if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else column.cast("double")


def _rank(value: Column, borders: Column) -> Column:
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(borders, lambda border: border <= value)))


def curve_place(rows: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> Column:
    """The place of a row on a curve through the ranges of all columns: the bits of its ranks, taken in turn.

    The borders of the ranges are quantiles, found in one pass over these columns; they reach the driver, 2**bits - 1 a column. Nulls lie
    before all values.
    """
    numbered = rows.select(*[_number(rows, name).alias(f"c{i}") for i, name in enumerate(columns)])
    shares = [i / 2**bits for i in range(1, 2**bits)]
    borders = numbered.approxQuantile(numbered.columns, shares, _RANK_ERROR)
    place: list[Column] = []
    for i, (name, found) in enumerate(zip(columns, borders, strict=True)):
        array = F.array(*[F.lit(b) for b in sorted(set(found))]) if found else F.array().cast("array<double>")
        rank = _rank(_number(rows, name), array)
        place += [F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1).cast("bigint"), bit * len(columns) + i) for bit in range(bits)]
    return reduce(Column.bitwiseOR, place)


def clustered(rows: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> DataFrame:
    """The rows in the order of the curve, dealt by ranges of it: written, each file covers small ranges of all the columns."""
    name = "_place"
    while name in rows.columns:
        name += "_"
    placed = rows.withColumn(name, curve_place(rows, columns, bits))
    return placed.repartitionByRange(name).sortWithinPartitions(name).drop(name)
