"""Intermediate tables in the shared folder, and row-wise columns computed over Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import shared_base


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share; see ``shared_base`` where that is unset."""
    return f"{shared_base(spark)}/llm/{purpose}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of an intermediate table through Hadoop's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Tables:
    """Tables that one run of an operator writes and reads again, so that no lineage is computed twice.

    ``drop`` deletes those that are no longer read. A table that the result still reads stays in the shared
    folder, like any checkpoint.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.folder = shared_folder(spark, purpose)
        self.count = 0
        self.paths: dict[int, str] = {}

    def store(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(stored)] = path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        for df in stored:
            delete_folder(self.spark, self.paths.pop(id(df)))


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that new columns of these names (in any case) replace."""
    taken = {name.lower() for name in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, for columns that are dropped again."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(id_col: str, text: str) -> Column:
    """Tells rows apart by 96 bits of their id and text; null ids and texts have keys like others."""
    return F.struct(F.xxhash64(id_col, text).alias("a"), F.hash(id_col, text).alias("b"))


def add_columns(
    df: DataFrame,
    compute: Callable[[pa.RecordBatch], dict[str, object]],
    fields: str,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with columns that ``compute`` returns for each Arrow batch, without the columns in ``drop``.

    A column of ``df`` that has the name of a new one is replaced. ``compute`` sees all columns.
    """
    new = StructType.fromDDL(fields)
    gone = {name.lower() for name in [*drop, *new.names]}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    schema = StructType([*(StructField(f.name, f.dataType, True) for f in kept), *new.fields])
    names = [f.name for f in kept]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not batch.num_rows:
                continue
            found = compute(batch)
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [c if isinstance(c, pa.Array) else pa.array(c) for c in (found[n] for n in new.names)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *new.names])

    return df.mapInArrow(batches, schema)
