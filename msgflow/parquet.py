"""How this library writes Parquet."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Snappy pages with dictionaries in the format every Parquet reader knows.
PARQUET_OPTIONS = {
    "compression": "snappy",
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "v1",
}


@contextmanager
def legacy_layout(spark: SparkSession) -> Iterator[None]:
    """Layout for old readers while it is open: two-level lists, decimals as fixed-length bytes.

    A streaming query takes the setting over when it starts.
    """
    setting = "spark.sql.parquet.writeLegacyFormat"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)
