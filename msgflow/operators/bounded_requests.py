"""Requests bounded by items and by bytes: order-keeping next-fit packing, in parallel.

A request takes the next items of its group until one more would exceed a bound. Where a request starts thus depends on all requests before it,
yet no task reads a whole group. Items are dealt by ranges of (group, order). Within a range every item's next start, and the last start that
follows from it, are found at once from prefix sums. What a range does to the request that is still open at its begin depends
only on that request's items and bytes, for which a short table of the range's first items is enough; the tables of a group's ranges are folded in
order, and then every range numbers its own items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, work_folder


def next_starts(sizes: np.ndarray, max_items: int, max_bytes: int) -> np.ndarray:
    """For each item the first one that no longer fits into a request that starts with it."""
    sums = np.append(0, np.cumsum(sizes))
    fits = np.searchsorted(sums, sums[:-1] + max_bytes, "right") - 1
    place = np.arange(len(sizes))
    return np.clip(fits, place + 1, np.minimum(place + max_items, len(sizes)))


def joined(sums: np.ndarray, items: int, size: int, max_items: int, max_bytes: int) -> int:
    """How many first items, whose prefix sums are given, an open request of so many items and bytes still takes."""
    if not items:
        return 0
    most = min(max_items - items, len(sums) - 1)
    return int(np.searchsorted(sums[: most + 1], max_bytes - size, "right") - 1) if most > 0 and size <= max_bytes else 0


def _table(sizes: np.ndarray, max_items: int, max_bytes: int) -> dict:
    """What a range does to an open request: for each item that may be its first start, the request that is open at its end."""
    n = len(sizes)
    following = next_starts(sizes, max_items, max_bytes)
    last = np.arange(n)
    for i in range(n - 1, -1, -1):
        if following[i] < n:
            last[i] = last[following[i]]
    sums = np.append(0, np.cumsum(sizes))
    heads = min(n, max_items)
    open_at = last[:heads]
    return {
        "n": n,
        "bytes": int(sums[-1]),
        "sums": sums[: heads + 1],
        "open_items": n - open_at,
        "open_bytes": sums[-1] - sums[open_at],
    }


def _fold(tables: list[dict], max_items: int, max_bytes: int) -> list[tuple[int, int]]:
    """The open request (items, bytes) at the begin of each of a group's ranges, in their order."""
    state, out = (0, 0), []
    for t in tables:
        out.append(state)
        start = joined(np.asarray(t["sums"]), *state, max_items, max_bytes)
        if start == t["n"]:
            state = (state[0] + t["n"], state[1] + t["bytes"])
        else:
            state = (t["open_items"][start], t["open_bytes"][start])
    return out


def _stored(table: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    path = work_folder(table.sparkSession, purpose)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path), path


#: A range holds 2**RANGE_BITS items at most.
RANGE_BITS = 18

_TABLE = "struct<n: bigint, bytes: bigint, sums: array<bigint>, open_items: array<bigint>, open_bytes: array<bigint>>"
_LISTS = pa.list_(pa.int64())
_ARROW_TABLE = pa.struct(
    [("n", pa.int64()), ("bytes", pa.int64()), ("sums", _LISTS), ("open_items", _LISTS), ("open_bytes", _LISTS)]
)


def _range_tables(ranged: DataFrame, max_items: int, max_bytes: int) -> DataFrame:
    """(_group, _range, table) from rows (_group, _range, sizes) that hold the sizes of a range's items of a group in their order."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [_table(np.asarray(s.values), max_items, max_bytes) for s in batch.column("sizes")]
            columns = [batch.column("_group"), batch.column("_range"), pa.array(tables, _ARROW_TABLE)]
            yield pa.RecordBatch.from_arrays(columns, names=["_group", "_range", "table"])

    kind = ranged.schema["_group"].dataType.simpleString()
    return ranged.select("_group", "_range", "sizes").mapInArrow(compute, f"_group {kind}, _range bigint, table {_TABLE}")


def _opened(tables: DataFrame, max_items: int, max_bytes: int) -> DataFrame:
    """(_group, _range, items, bytes): the request that is open where a range begins.

    A row holds the tables of a group, at most ``max_items`` numbers a range; their number is that of the ranges, not of the items.
    """
    kind = tables.schema["_group"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index in range(batch.num_rows):
                parts = sorted(batch.column("parts")[index].as_py(), key=lambda part: part["_range"])
                states = _fold([part["table"] for part in parts], max_items, max_bytes)
                groups = batch.column("_group").take(pa.array([index] * len(parts)))
                ranges = pa.array([part["_range"] for part in parts], pa.int64())
                items, sizes = (pa.array(values, pa.int64()) for values in zip(*states))
                yield pa.RecordBatch.from_arrays([groups, ranges, items, sizes], names=["_group", "_range", "items", "bytes"])

    gathered = tables.groupBy("_group").agg(F.collect_list(F.struct("_range", "table")).alias("parts"))
    return gathered.mapInArrow(compute, f"_group {kind}, _range bigint, items bigint, bytes bigint")


def _starts(opened: DataFrame, max_items: int, max_bytes: int) -> DataFrame:
    """(_group, _range, n_starts, of): ``of`` has for each item of the range how many requests start at it or before it in the range."""
    kind = opened.schema["_group"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, counts = [], []
            for sizes, items, size in zip(*(batch.column(c) for c in ("sizes", "items", "bytes"))):
                sizes = np.asarray(sizes.values)
                begins = np.zeros(len(sizes), np.int64)
                heads = np.append(0, np.cumsum(sizes[:max_items]))
                following = next_starts(sizes, max_items, max_bytes)
                at = joined(heads, items.as_py(), size.as_py(), max_items, max_bytes)
                while at < len(sizes):
                    begins[at] = 1
                    at = int(following[at])
                of.append(np.cumsum(begins))
                counts.append(int(begins.sum()))
            columns = [batch.column("_group"), batch.column("_range"), pa.array(counts, pa.int64()), pa.array(of, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_group", "_range", "n_starts", "of"])

    return opened.mapInArrow(compute, f"_group {kind}, _range bigint, n_starts bigint, of array<bigint>")


def bounded_request_batches(
    items: DataFrame,
    *,
    group: str,
    order: str,
    max_items: int,
    max_bytes: int,
    content: Column,
    item_bytes: Column | None = None,
) -> DataFrame:
    """Items of each group, in the given order, in requests of at most ``max_items`` items and ``max_bytes`` bytes.

    Returns the group, ``request_no`` from 0, ``items`` (pairs of position and content, in order) and ``items_bytes``. A request takes
    items as long as they fit; one that is larger than ``max_bytes`` by itself is alone in its request. The size of an item is
    ``item_bytes``, by default that of its content in UTF-8 (``requests.item_json_bytes`` has its size in a body). ``order`` is an integer
    column; items of a group that share one come by size, then by a hash of the content. A null content has size 0.

    Places are found from keys and sizes alone; contents are joined to them and meet in requests only. A task holds the keys and sizes of a range
    of items, and one row the tables of a group's ranges. The table of places stays below the work folder, as the result reads it.
    """
    if not isinstance(items.schema[order].dataType, T.IntegralType):
        raise ValueError(f"{order} must be an integer column, not {items.schema[order].dataType.simpleString()}")
    if max_items < 1 or max_bytes < 0:
        raise ValueError("a request holds one item at least, and its bytes are not negative")
    size = F.coalesce(item_bytes if item_bytes is not None else F.octet_length(content.cast("string")), F.lit(0)).cast("bigint")
    narrow = items.select(
        F.col(group).alias("_group"), F.col(order).alias("_order"), size.alias("_size"), content.alias("_content")
    ).withColumn("_hash", F.xxhash64(F.col("_content")))
    key = ["_group", "_order", "_size", "_hash"]
    keys = narrow.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"))
    keys = keys.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    ranged = keys.repartitionByRange(*key, "_copy").sortWithinPartitions(*key, "_copy")
    # Ids ascend within a task and from task to task, so their upper bits number ranges of the order.
    ranged = ranged.withColumn("_range", F.shiftright(F.monotonically_increasing_id(), RANGE_BITS))
    ranged, keys_path = _stored(ranged, "bounded-keys")
    spark = items.sparkSession

    place = F.sort_array(F.collect_list(F.struct("_order", "_size", "_hash", "_copy", "_copies")))
    parts = ranged.groupBy("_group", "_range").agg(place.alias("_places")).withColumn("sizes", F.col("_places._size"))
    parts, parts_path = _stored(parts, "bounded-ranges")
    tables, tables_path = _stored(_range_tables(parts, max_items, max_bytes), "bounded-tables")
    same = lambda other: F.col("p._group").eqNullSafe(other["_group"]) & (F.col("p._range") == other["_range"])
    opened = _opened(tables, max_items, max_bytes)
    opened = parts.alias("p").join(opened, same(opened)).select("p._group", "p._range", "p.sizes", opened["items"], opened["bytes"])
    starts, starts_path = _stored(_starts(opened, max_items, max_bytes), "bounded-starts")
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = starts.select("_group", "_range", "of", F.coalesce(F.sum("n_starts").over(before), F.lit(0)).alias("_before"))
    numbered = parts.alias("p").join(offsets, same(offsets)).select(
        "p._group", "_before", F.explode(F.arrays_zip(F.col("p._places").alias("place"), F.col("of"))).alias("_at")
    )
    numbered = numbered.select(
        "_group", "_at.place.*", (F.col("_before") + F.col("_at.of") - 1).alias("request_no")
    )
    places, _ = _stored(numbered, "bounded-places")
    for path in (keys_path, parts_path, tables_path, starts_path):
        delete_folder(spark, path)

    if places.where("_copies > 1").isEmpty():
        narrow = narrow.withColumn("_copy", F.lit(1))
    else:
        narrow = narrow.withColumn("_copy", F.row_number().over(Window.partitionBy(*key).orderBy("_hash")))
    n, p = narrow.alias("n"), places.alias("p")
    matches = [F.col(f"n.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*key, "_copy")]
    met = n.join(p, matches[0] & matches[1] & matches[2] & matches[3] & matches[4])
    item = F.struct(F.col("n._order").alias("position"), F.col("n._size").alias("_size"), F.col("n._hash").alias("_hash"), F.col("_content").alias("content"))
    met = met.select(F.col("n._group").alias(group), "request_no", F.col("n._size").alias("_size"), item.alias("_item"))
    packed = met.groupBy(group, "request_no").agg(
        F.sort_array(F.collect_list("_item")).alias("_items"), F.sum("_size").alias("items_bytes")
    )
    pairs = F.transform("_items", lambda i: F.struct(i["position"].alias("position"), i["content"].alias("content")))
    return packed.select(group, "request_no", pairs.alias("items"), "items_bytes")
