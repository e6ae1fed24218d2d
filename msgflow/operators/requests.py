"""Scoring requests: items grouped N per request, JSON bodies, and a hook for the caller's scorer."""

from __future__ import annotations

import gc
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, work_folder


# The sampling settings that a request has unless others are asked for.
TEMPERATURE, TOP_P, MAX_TOKENS = 0.5, 0.95, 3000


def _stored(table: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    path = work_folder(table.sparkSession, purpose)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path), path


def _ranked(items: DataFrame, group: str, order: str) -> DataFrame:
    """(group, order, rank, n): how many items of the group come before those with this order, and how many have it.

    Only the two key columns are handled. They are dealt by ranges of (group, order), so a large group lies in many
    ranges and a task never sees more than its range; the items before a range are added up from the ranges' sizes.
    """
    keys = items.groupBy(F.col(group).alias("_group"), F.col(order).alias("_order")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = keys.repartitionByRange("_group", "_order").withColumn("_range", F.spark_partition_id())
    ranged, path = _stored(ranged, "request-ranges")
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_group", "_range").agg(F.sum("_n").alias("_items"))
    starts = sizes.select(
        F.col("_group").alias("_of"),
        F.col("_range").alias("_at"),
        F.coalesce(F.sum("_items").over(before), F.lit(0)).alias("_start"),
    )
    earlier = Window.partitionBy("_group", "_range").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_earlier", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    same = F.col("_group").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at"))
    ranks = placed.join(starts, same).select("_group", "_order", (F.col("_start") + F.col("_earlier")).alias("_rank"), "_n")
    ranks, _ = _stored(ranks, "request-ranks")
    delete_folder(items.sparkSession, path)
    return ranks


def request_batches(items: DataFrame, *, group: str, order: str, size: int, content: Column) -> DataFrame:
    """Items of each group, in the given order, ``size`` per request.

    ``order`` is an integer column. Returns the group, ``request_no`` from 0, and ``items``: at most ``size`` pairs
    (position, content). The places of the items are found from the two key columns alone, whatever the sizes of
    the groups; contents are joined to them and meet in requests only. Items that share a group and an order take
    consecutive places in any order. The table of places stays below the work folder, as the result reads it.
    """
    if not isinstance(items.schema[order].dataType, T.IntegralType):
        raise ValueError(f"{order} must be an integer column, not {items.schema[order].dataType.simpleString()}")
    ranks = _ranked(items, group, order)
    narrow = items.select(group, order, content.alias("_content"))
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(order).eqNullSafe(F.col("_order"))
    placed = narrow.join(ranks, same)
    rank = F.col("_rank")
    if not ranks.where("_n > 1").isEmpty():
        among = Window.partitionBy("_group", "_order").orderBy("_order")
        rank = rank + F.row_number().over(among) - 1
    item = F.struct(F.col(order).alias("position"), F.col("_content").alias("content"))
    return (
        placed.select(group, F.floor(rank / size).alias("request_no"), item.alias("_item"))
        .groupBy(group, "request_no")
        .agg(F.sort_array(F.collect_list("_item")).alias("items"))
    )


def request_bodies(
    batches: DataFrame,
    *,
    system: str,
    prompt: str,
    domain: str,
    model: str,
    temperature: float = TEMPERATURE,
    top_p: float = TOP_P,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """Adds ``body``, the JSON text of each request, and ``body_bytes``, its size.

    The user message holds one ``image`` object per item, then one text object.
    """
    content = F.concat(
        F.transform(
            "items",
            lambda item: F.struct(
                item["content"].alias("image"),
                F.lit(None).cast("string").alias("type"),
                F.lit(None).cast("string").alias("text"),
            ),
        ),
        F.array(
            F.struct(F.lit(None).cast("string").alias("image"), F.lit("text").alias("type"), F.lit(prompt).alias("text"))
        ),
    )
    user = F.to_json(F.struct(F.lit("user").alias("role"), content.alias("content")))
    # Everything but the user message is the same for all requests, so it is put around as text.
    frame = {
        "domainName": domain,
        "modelName": model,
        "modelPayload": {
            "messages": [{"role": "system", "content": system}, "USER"],
            "temperature": temperature,
            "top_p": top_p,
            "max_tokens": max_tokens,
        },
    }
    before, after = json.dumps(frame, ensure_ascii=False, separators=(",", ":")).rsplit('"USER"', 1)
    body = F.concat(F.lit(before), user, F.lit(after))
    return batches.withColumn("body", body).withColumn("body_bytes", F.octet_length("body"))


def item_json_bytes(content: Column) -> Column:
    """What an item adds to the size of a body."""
    return F.octet_length(F.to_json(F.struct(content.alias("image")))) + 1


def room_for_items(spark: SparkSession, max_body_bytes: int, **request: str | float | int) -> int:
    """The bytes that a body of at most ``max_body_bytes`` leaves to its items; ``request`` are the arguments of ``request_bodies``."""
    empty = spark.createDataFrame([([],)], "items array<struct<position: bigint, content: string>>")
    return max_body_bytes - request_bodies(empty, **request).first()["body_bytes"]


Scorer = Callable[[pd.Series], pd.DataFrame]

#: Bytes of bodies that a scorer gets at once, unless one body alone has more.
CALL_BYTES = 4_000_000


def _bounded_calls(bodies: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of the runs of consecutive bodies that have ``CALL_BYTES`` together, or are one body."""
    sizes = pc.fill_null(pc.binary_length(bodies), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CALL_BYTES, side="right")))
        yield start, stop - start
        start = stop


def score_requests(requests: DataFrame, scorer: Scorer, *, fail_on_error: bool = False) -> DataFrame:
    """Calls ``scorer`` with batches of bodies; it returns the columns ``status`` and ``response``.

    The other columns of ``requests`` are passed through. A status other than 200 leaves the response
    in ``error`` and ``response`` null, or fails the job if ``fail_on_error``. A batch has ``CALL_BYTES`` of bodies, or
    one body that is larger, so what a scorer makes of them stays small. What Spark sends to Python at once follows
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``.
    """
    passed = [f for f in requests.schema.fields if f.name != "body"]
    at = requests.columns.index("body")

    def scored(run: pa.RecordBatch) -> pa.RecordBatch:
        answers = scorer(pd.Series(run.column(at).to_pandas(), name="body"))
        status = answers["status"].to_numpy()
        failed = status != 200
        if fail_on_error and failed.any():
            raise RuntimeError(f"{failed.sum()} of {run.num_rows} scoring requests failed")
        text = run.column(at).type
        response = pd.Series(answers["response"].to_numpy())
        columns = [run.column(i) for i in range(run.num_columns) if i != at]
        columns += [
            pa.array(status, pa.int32(), from_pandas=True),
            pa.array(response.mask(failed, None), text, from_pandas=True),
            pa.array(response.where(failed, None), text, from_pandas=True),
        ]
        names = [name for i, name in enumerate(run.schema.names) if i != at]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "status", "response", "error"])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in _bounded_calls(batch.column(at)):
                yield scored(batch.slice(start, length))
            # A series whose ``str`` was used is a cycle with its accessor, so bodies would pile up until Python looks for cycles.
            del batch
            gc.collect()

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in passed)
    prefix = f"{columns}, " if columns else ""
    return requests.mapInArrow(call, f"{prefix}status INT, response STRING, error STRING")
