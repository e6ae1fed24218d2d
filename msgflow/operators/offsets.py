"""An account of a topic's offsets: which ranges are there once, which are lost, and which came more than once.

Messages are borders first: an offset adds one at itself and takes one away behind itself, so of a stretch of consecutive offsets only its two ends
remain. Every task adds up its own borders before they are shuffled. The number of copies at any offset is the running sum of the
borders; it is summed within ranges of the offsets, and carried from range to range by the ranges' totals alone. An account that has
been stored is a set of such stretches, so it takes in a batch by adding the batch's borders to its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A range holds 2**RANGE_BITS borders at most.
RANGE_BITS = 16
STRETCH = "topic string, partition int, first_offset bigint, last_offset bigint, copies bigint"
_BORDER = "topic string, partition int, at bigint, change bigint"


def _borders(envelope: DataFrame) -> DataFrame:
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).group_by(["topic", "partition"]).aggregate([("offset", "list")])
            for topic, partition, offsets in zip(*(rows.column(c) for c in ("topic", "partition", "offset_list"))):
                offsets = np.asarray(offsets.values)
                at, where = np.unique(np.concatenate([offsets, offsets + 1]), return_inverse=True)
                change = np.bincount(where[: len(offsets)], minlength=len(at)) - np.bincount(where[len(offsets) :], minlength=len(at))
                kept = np.flatnonzero(change)
                same = pa.array(np.zeros(len(kept), np.int32))
                columns = [
                    pa.array([topic.as_py()], pa.string()).take(same),
                    pa.array([partition.as_py()], pa.int32()).take(same),
                    pa.array(at[kept], pa.int64()),
                    pa.array(change[kept], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["topic", "partition", "at", "change"])

    placed = envelope.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"))
    return placed.where("offset is not null").mapInArrow(ends, _BORDER)


def _borders_of(stretches: DataFrame) -> DataFrame:
    first = F.struct(F.col("first_offset").alias("at"), F.col("copies").alias("change"))
    behind = F.struct((F.col("last_offset") + 1).alias("at"), (-F.col("copies")).alias("change"))
    return stretches.select("topic", "partition", F.inline(F.array(first, behind)))


def _stretches(borders: DataFrame) -> DataFrame:
    place = ["topic", "partition", "at"]
    summed = borders.groupBy(*place).agg(F.sum("change").alias("change")).where("change <> 0")
    ordered = summed.repartitionByRange(*place).sortWithinPartitions(*place)
    # Ids ascend within a task and from task to task, so their upper bits number ranges of the order.
    ranged = ordered.withColumn("range", F.shiftright(F.monotonically_increasing_id(), RANGE_BITS))
    inside = Window.partitionBy("topic", "partition", "range").orderBy("at")
    running = ranged.select(
        *place,
        "range",
        F.sum("change").over(inside).alias("running"),
        F.lead("at").over(inside).alias("next"),
    )
    across = Window.partitionBy("topic", "partition").orderBy("range")
    totals = ranged.groupBy("topic", "partition", "range").agg(F.sum("change").alias("total"), F.min("at").alias("start"))
    carried = totals.select(
        F.col("topic").alias("of_topic"),
        F.col("partition").alias("of_partition"),
        F.col("range").alias("of_range"),
        F.coalesce(F.sum("total").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lead("start").over(across).alias("next_start"),
    )
    same = (
        F.col("topic").eqNullSafe(F.col("of_topic"))
        & F.col("partition").eqNullSafe(F.col("of_partition"))
        & (F.col("range") == F.col("of_range"))
    )
    behind = F.coalesce("next", "next_start")
    return running.join(carried, same).where(behind.isNotNull()).select(
        "topic",
        "partition",
        F.col("at").alias("first_offset"),
        (behind - 1).alias("last_offset"),
        (F.col("running") + F.col("before")).alias("copies"),
    )


def offset_account(envelope: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(topic, partition, first_offset, last_offset, copies): the stretches of offsets with equal numbers of copies, without holes.

    A stretch with 0 copies lies between others and is lost. ``known`` is an account to which the messages are added. Only the
    columns topic, partition and offset are read; messages without an offset are left out. A topic or partition that is null is one of its own.
    No task holds a whole partition. An empty topic has no stretch.
    """
    borders = _borders(envelope)
    if known is not None:
        borders = borders.unionByName(_borders_of(known.where("copies > 0")))
    return _stretches(borders)


def offset_gaps(account: DataFrame) -> DataFrame:
    """(topic, partition, kind, first_offset, last_offset, copies): the lost and the repeated stretches of an account."""
    kind = F.when(F.col("copies") == 0, "missing").otherwise("repeated")
    return account.where("copies <> 1").select("topic", "partition", kind.alias("kind"), "first_offset", "last_offset", "copies")
