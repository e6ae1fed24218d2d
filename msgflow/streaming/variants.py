"""Payloads stored as variants: no schema to decide on, so none that changes.

Spark shreds the fields that messages have in common into typed Parquet columns of their own, file by file. A field whose type changes is
stored as it is in every file: no new version of a folder, and no cast of what was written before. Readers name the type they want.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_fields import keep_repeated_keys
from ..operators.policies import CORRUPT
from ..sources.envelope import ORIGIN
from .batches import BatchWriter, Report, discard_batch, log_counts
from .published import OutputLog

PAYLOAD = "payload"


def variant_rows(messages: DataFrame, *, keep: Sequence[str] = ORIGIN) -> DataFrame:
    """Each message with its payload as a variant; a text that is no JSON has none, and stands in ``_corrupt_record``.

    A message without a value has neither. JSON of any kind is a payload, objects, lists and single values alike; a repeated key keeps its last
    value.
    """
    keep_repeated_keys(messages.sparkSession)
    parsed = messages.select(*keep, "json_string", F.try_parse_json("json_string").alias(PAYLOAD))
    return parsed.select(*keep, PAYLOAD, F.when(F.col(PAYLOAD).isNull(), F.col("json_string")).alias(CORRUPT))


def variant_field(name: str, kind: str = "string", payload: str = PAYLOAD) -> Column:
    """A field of the payload, by its path of names joined by dots, as a type; null where it is absent or of another type.

    A filter on it reaches the scan: files whose statistics of the shredded field rule it out are not read.
    """
    path = "$" + "".join(f'["{part}"]' for part in name.split("."))
    return F.try_variant_get(payload, path, kind)


def variant_fields(rows: DataFrame, schema: T.StructType, *, keep: Sequence[str] = ORIGIN) -> DataFrame:
    """The rows with the fields of a schema as columns; only these fields are read from files that have shredded them."""
    fields = [variant_field(f.name, f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return rows.select(*keep, *fields)


class VariantBatches(BatchWriter):
    """Messages with their payloads as variants, those that are no JSON in the same folder, one write a batch."""

    def __init__(
        self, path: str, *, keep: Sequence[str] = ORIGIN, report: Report = log_counts, log: OutputLog | None = None
    ):
        self.path = path
        self.keep = keep
        self.report = report
        self.log = log

    def sides(self) -> list[str]:
        return [self.path]

    def process(self, batch: DataFrame, batch_id: int) -> Mapping[str, int]:
        counted = Observation()
        bad = F.col(CORRUPT).isNotNull()
        measures = [F.count(F.lit(1)).alias("seen"), F.count_if(~bad).alias("kept"), F.count_if(bad).alias("rejected")]
        self.put(variant_rows(batch, keep=self.keep).observe(counted, *measures), self.path, batch_id)
        return counted.get

    def discard(self, batch: DataFrame, batch_id: int) -> None:
        discard_batch(batch.sparkSession, self.path, batch_id)
