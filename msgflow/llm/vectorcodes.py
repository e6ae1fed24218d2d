"""Vectors as four one-byte codes, learnt and applied with per-dimension value dictionaries, all in integers.

Vectors become integers and are stored once in blocks: for each dimension the block's distinct integers, ascending, and each vector's place
among them. A pass over the blocks tabulates, dimension by dimension, the squared differences of every distinct integer to all entries of
the codebook; the distances of the parts are then rows of these tables, gathered by the places and added up. A value that many vectors share
is compared with the codebook once a block. Sums of the parts of an entry leave a task, never vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables, unused, without

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Vectors, and places (vectors times dimensions), of a block at most, which bounds what a task holds.
BLOCK_VECTORS = 1 << 12
BLOCK_PLACES = 1 << 18
#: Components of at most this magnitude have squared distances, over 4,096 dimensions, within 64 bits.
LARGEST = 1 << 24
#: The sums of labels are broadcast up to this many labels; beyond it Spark joins by label, and splits a hot one.
BROADCAST_LABELS = 200_000

_BLOCK = "n int, dims int, distinct binary, values binary, places binary, ids array<bigint>, labels array<string>"


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """(vectors, width) of floor(SCALE * component); shorter vectors are filled up with zeros."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST / SCALE:.0f} can not be coded: their squared distances do not fit 64 bits")
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _encoded(rows: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """The dictionaries of a block: numbers of distinct integers, the integers by dimension, and the places of all vectors."""
    n, dims = rows.shape
    counts, values, places = np.zeros(dims, "<i4"), [], np.zeros((dims, n), "<u4")
    for d in range(dims):
        distinct, places[d] = np.unique(rows[:, d], return_inverse=True)
        counts[d] = len(distinct)
        values.append(distinct.astype("<i8"))
    return counts.tobytes(), np.concatenate(values).tobytes() if values else b"", places.tobytes()


class _Block:
    def __init__(self, n: int, dims: int, distinct: bytes, values: bytes, places: bytes) -> None:
        self.n, self.dims = n, dims
        ends = np.cumsum(np.frombuffer(distinct, "<i4"))
        self.values = np.split(np.frombuffer(values, "<i8"), ends[:-1]) if dims else []
        self.places = np.frombuffer(places, "<u4").reshape(dims, n)

    def nearest(self, part: int, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the entry nearest to its part (of equal ones the first), and the squared distance."""
        width = self.dims // PARTS
        distances = np.zeros((self.n, len(book)), np.int64)
        for d in range(part * width, (part + 1) * width):
            table = np.square(self.values[d][:, None] - book[None, :, d - part * width])
            distances += table[self.places[d]]
        codes = distances.argmin(1)
        return codes, distances[np.arange(self.n), codes]

    def sums(self, part: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries that occur among the codes, how often, and the sums of the parts that have them."""
        order = np.argsort(codes, kind="stable")
        entries, starts, counts = np.unique(codes[order], return_index=True, return_counts=True)
        width = self.dims // PARTS
        out = np.zeros((len(entries), width), np.int64)
        for d in range(width):
            at = part * width + d
            out[:, d] = np.add.reduceat(self.values[at][self.places[at]][order], starts)
        return entries, counts, out


def _usable(vector: str) -> Column:
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _blocks(rows: DataFrame, dims: int) -> DataFrame:
    size = max(1, min(BLOCK_VECTORS, BLOCK_PLACES // max(1, dims)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, size):
                ids, labels, vectors = (batch.slice(begin, size).column(i) for i in range(3))
                counts, values, places = _encoded(_integers(vectors, dims))
                yield pa.RecordBatch.from_pydict(
                    {
                        "n": pa.array([len(ids)], pa.int32()),
                        "dims": pa.array([dims], pa.int32()),
                        "distinct": [counts],
                        "values": [values],
                        "places": [places],
                        "ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                        "labels": pa.array([labels.to_pylist()], pa.list_(pa.string())),
                    }
                )

    return rows.mapInArrow(encode, _BLOCK)


def _sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, sums): for each entry that is the nearest one of any part, how many parts and their componentwise sums."""
    width = books.shape[2]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(**row)
                for part, book in enumerate(books):
                    entries, n, sums = block.sums(part, block.nearest(part, book)[0])
                    counts[part, entries] += n
                    totals[part, entries] += sums
        part, entry = np.nonzero(counts)
        if len(part):
            sums = pa.array(list(totals[part, entry]), pa.list_(pa.int64()))
            columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), sums]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    partial = blocks.select("n", "dims", "distinct", "values", "places").mapInArrow(
        added, "part int, entry int, n long, sums array<long>"
    )
    components = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *components)


def _coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every vector."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = row.pop("ids"), row.pop("labels")
                block = _Block(**row)
                found = [block.nearest(part, book) for part, book in enumerate(books)]
                codes = np.stack([codes for codes, _ in found], 1).astype(np.uint8)
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array(labels, pa.string()),
                    pa.array([row.tobytes().hex() for row in codes], pa.string()),
                    pa.array(np.sum([errors for _, errors in found], 0), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    return blocks.mapInArrow(code, "id long, label string, code string, error long")


def learn_codebooks(blocks: DataFrame, seeds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """(part, entry, position) after ``rounds`` of assignment and floored means, from the seeds (vector, dimension).

    A round brings at most PARTS * ENTRIES rows of sums to the driver.
    """
    books = np.stack(np.split(seeds, PARTS, axis=1))
    for _ in range(rounds):
        for row in _sums(blocks, books).collect():
            part, entry, n, *sums = row
            books[part, entry] = [s // n for s in sums]
    return books


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every vector without null or non-finite components.

    ``code`` has the entry of each part in two hex digits, ``error`` the squared distance of the integers to their entries, ``label_error``
    its sum over the vectors of the label; null labels count as one label. Codebooks start from the vectors with the least ids (null
    ids come last, and of vectors with one id the lesser vector comes first). Vectors of different lengths are filled up with zeros to
    the longest one and a multiple of PARTS. Repeated rows count as often as they occur. An empty table, or one without a usable vector, gives
    an empty result. Further columns of ``vectors`` are not read. A component beyond 16,384 in magnitude is an error: its squared
    distances do not fit a long.
    """
    spark = vectors.sparkSession
    tables = Tables(spark, "vector-codes")
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    ).where(_usable("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dims = -(-longest // PARTS) * PARTS
    label_type = vectors.schema[label_col].dataType
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).select("v").toArrow()["v"].combine_chunks()
    blocks = tables.store(_blocks(rows, dims))
    books = learn_codebooks(blocks, _integers(first, dims), rounds)
    coded = tables.store(_coded(blocks, books))
    tables.drop(blocks)
    sums = tables.store(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    joined = coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("c.label").cast(label_type).alias(label_col),
        "code",
        "error",
        "label_error",
        F.lit(codebook_digest(books)).alias("codebooks_sha256"),
    )
