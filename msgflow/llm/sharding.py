"""Sharding by histogram sort: probes are refined until splitters are exact enough, then rows are exchanged once.

The sort key of a row is (hash of its text, id): equal texts are neighbours, and sizes are spread evenly over the hashes.
Each round counts, over all partitions, the bytes and rows between neighbouring probes; the driver sees a row for each pair
of neighbouring probes and puts new ones where a splitter is not found yet. Shards are cut into pieces, which are found in
the same way, so that the exchange is even whatever the number of shards, and rows are numbered piece by piece.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import Tables, unused, without

ROW_BYTES = 16
#: A shard's size may differ from the mean by this share of it.
TOLERANCE = 0.05
#: Pieces of a shard at least, and the bytes that a piece should not exceed by much.
PIECES, PIECE_BYTES = 32, 256 << 20
PROBES = 8

_LOW, _SPAN = -(1 << 63), 1 << 64


def _joined(h: int, d: int) -> int:
    """A key (hash, id) as one number, in the same order."""
    return (h - _LOW) * _SPAN + (d - _LOW)


def _parted(key: int) -> tuple[int, int]:
    return key // _SPAN + _LOW, key % _SPAN + _LOW


def places(ph: np.ndarray, pd: np.ndarray, h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """How many of the ascending probes (ph, pd) are at most (h, d), for each row."""
    low, high = np.searchsorted(ph, h, "left"), np.searchsorted(ph, h, "right")
    out = low.copy()
    tied = np.flatnonzero(low < high)
    for value in np.unique(h[tied]):
        rows = tied[h[tied] == value]
        a, b = low[rows[0]], high[rows[0]]
        out[rows] = a + np.searchsorted(pd[a:b], d[rows], "right")
    return out


class Bucket(NamedTuple):
    """The rows between two neighbouring probes: how much lies below them, what they hold, their least and greatest key."""

    below: int
    rows_below: int
    size: int
    rows: int
    least: int
    most: int


class Cut(NamedTuple):
    """A splitter: rows whose key is at least ``key`` come after it; bytes and rows below it."""

    key: int
    below: int
    rows_below: int


def histogram(keys: DataFrame, probes: list[int]) -> list[Bucket]:
    """The non-empty buckets between ascending probes, exactly: partitions count by themselves, then the counts are added."""
    parts = [_parted(p) for p in probes]
    ph, pd = (np.array([p[i] for p in parts], np.int64) for i in (0, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h, d, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "d", "size"))
                at = places(ph, pd, h, d)
                order = np.lexsort((d, h))
                at, h, d, size = at[order], h[order], d[order], size[order]
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                last = np.append(first[1:], len(at)) - 1
                columns = [at[first], np.add.reduceat(size, first), last - first + 1, h[first], d[first], h[last], d[last]]
                names = ["at", "size", "rows", "h0", "d0", "h1", "d1"]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    fields = ", ".join(f"{c} bigint" for c in ("at", "size", "rows", "h0", "d0", "h1", "d1"))
    found = (
        keys.mapInArrow(count, fields)
        .groupBy("at")
        .agg(F.sum("size"), F.sum("rows"), F.min(F.struct("h0", "d0")), F.max(F.struct("h1", "d1")))
        .collect()
    )
    out, below, rows_below = [], 0, 0
    for _, size, rows, least, most in sorted(found, key=lambda r: r[0]):
        out.append(Bucket(below, rows_below, size, rows, _joined(*least), _joined(*most)))
        below, rows_below = below + size, rows_below + rows
    return out


def splitters(keys: DataFrame, targets: list[tuple[float, float, bool]]) -> list[Cut]:
    """A cut for each ascending target (value, tolerance, whole): as many bytes below it as the value, within the tolerance.

    Where ``whole``, a cut lies inside a group of one hash only if no border of the group is within the tolerance. Rows
    with the same hash and id can not be parted; there the nearer side is taken.
    """
    found: dict[int, Cut] = {}
    n = PROBES * len(targets)
    probes = [_SPAN * _SPAN * i // (n + 1) // _SPAN * _SPAN for i in range(1, n + 1)]
    while True:
        buckets = histogram(keys, probes)
        if not buckets:
            return [Cut(0, 0, 0)] * len(targets)
        ends = [b.below + b.size for b in buckets]
        # Whether the border before each bucket lies inside a group of one hash.
        inside = [False, *(a.most // _SPAN == b.least // _SPAN for a, b in zip(buckets[:-1], buckets[1:], strict=True)), False]
        refine = set()
        for i, (value, tolerance, whole) in enumerate(targets):
            if i in found:
                continue
            k = min(bisect_right(ends, value), len(buckets) - 1)
            b = buckets[k]
            above = buckets[k + 1].least if k + 1 < len(buckets) else b.most + 1
            borders = [
                (Cut(b.least, b.below, b.rows_below), inside[k]),
                (Cut(above, ends[k], b.rows_below + b.rows), inside[k + 1]),
            ]
            one_group = b.least // _SPAN == b.most // _SPAN
            near = [c for c, splits in borders if abs(c.below - value) <= tolerance and not (whole and splits and not one_group)]
            if near or b.least == b.most:
                found[i] = min(near or [c for c, _ in borders], key=lambda c: abs(c.below - value))
            else:
                refine.add(k)
        if not refine:
            return [found[i] for i in range(len(targets))]
        probes = sorted(set(_refined(buckets, refine, max(2, n // len(refine)))))


def _refined(buckets: list[Bucket], refine: set[int], n: int) -> Iterator[int]:
    """The borders of the buckets to refine and ``n`` probes in each: between groups, or within its only group."""
    for k in refine:
        b = buckets[k]
        if k:
            yield b.least
        if k + 1 < len(buckets):
            yield buckets[k + 1].least
        one_group = b.least // _SPAN == b.most // _SPAN
        for i in range(1, n + 1):
            at = b.least + (b.most - b.least) * i // (n + 1)
            yield max(at, b.least + 1) if one_group else max(at // _SPAN, b.least // _SPAN + 1) * _SPAN


def shard_rows(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text: str = "text",
    tolerance: float = TOLERANCE,
    pieces: int = PIECES,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``: every row in one shard, shards near equal in bytes.

    ``size`` is the UTF-8 length of the text (null: none) plus 16. A shard's bytes differ from the mean by at most
    ``tolerance`` of it, or by a single row or set of indistinguishable rows (same text and id) where that is larger.
    Equal texts share a shard, unless a border falls into a group of them that reaches further than the tolerance. ``slot``
    numbers a shard's rows from 0 in the order of the key. Null texts are a group of their own, null ids come first in
    it. Rows that repeat text and id get the slots of their piece in any order. Other columns stay as they are; columns
    named like the new ones are replaced. An empty table gives an empty result.
    """
    tables = Tables(docs.sparkSession, "sharding")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES
    h, d = F.xxhash64(text), F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    keys = tables.store(docs.select(h.alias("h"), d.alias("d"), size.alias("size")))
    total = keys.agg(F.sum("size")).first()[0] or 0
    per_shard = max(pieces, math.ceil(total / shards / piece_bytes))
    piece = total / shards / per_shard
    targets = [
        (piece * i, tolerance * total / shards / 2 if i % per_shard == 0 else piece / 4, i % per_shard == 0)
        for i in range(1, shards * per_shard)
    ]
    cuts = splitters(keys, targets) if targets else []
    tables.drop(keys)

    # The cuts of whole shards decide; a cut between pieces that lies beyond its shard's border moves to the border.
    cuts = [Cut(0, 0, 0), *cuts]
    for s in range(0, len(cuts), per_shard):
        upper = cuts[s + per_shard] if s + per_shard < len(cuts) else None
        for i in range(s + 1, min(s + per_shard, len(cuts))):
            cuts[i] = max(cuts[i], cuts[i - 1])
            cuts[i] = min(cuts[i], upper) if upper else cuts[i]
    ph, pd_ = (np.array([_parted(c.key)[i] for c in cuts[1:]], np.int64) for i in (0, 1))
    firsts = np.array([c.rows_below - cuts[i // per_shard * per_shard].rows_below for i, c in enumerate(cuts)], np.int64)

    @F.pandas_udf("piece bigint, first bigint")
    def piece_of(h: pd.Series, d: pd.Series) -> pd.DataFrame:
        piece = places(ph, pd_, h.to_numpy(), d.to_numpy())
        return pd.DataFrame({"piece": piece, "first": firsts[piece]})

    rows = without(docs, ["size", "shard", "slot"])
    hash_, id_, cut, piece_ = unused(rows, "_h", "_d", "_cut", "_piece")
    dealt = rows.withColumns({"size": size, hash_: h, id_: d}).withColumn(cut, piece_of(hash_, id_))
    dealt = dealt.withColumn(piece_, F.col(f"{cut}.piece"))
    row = F.row_number().over(Window.partitionBy(piece_).orderBy(hash_, id_))
    return dealt.withColumns(
        {
            "shard": F.floor(F.col(piece_) / per_shard).cast("int"),
            "slot": F.col(f"{cut}.first") + row.cast("bigint") - 1,
        }
    ).drop(hash_, id_, cut, piece_)
