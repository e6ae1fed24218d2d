"""SimHash near-duplicates: fingerprints, pivot distance tables, links within a Hamming distance, components.

Pivot distances. The Hamming distance is a metric, so for every reference fingerprint p (a pivot) the distances
d(x, p) and d(y, p) differ by at most d(x, y). A table of the distances of the fingerprints to ``PIVOTS`` full-width
pivots is computed for every tile of candidates; a pair whose coordinates differ by more than ``max_bits`` anywhere is discarded,
and the survivors are verified by their exact distance. Distances of 64 bits are cheap themselves, so the table saves no time; it is the
method's own filter, and loses nothing.

The same bound, for pivots that see only one part of the bits, finds the candidates without comparing everything
with everything: of ``PARTS`` parts, ``max_bits`` differing bits leave at least ``PARTS - max_bits`` parts alike, and
there the distances to all pivots of those parts are equal. The distances of a part to the zero pivot and to those with
one bit set determine the part's bits, so the bits themselves serve as the join key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .tables import Tables, add_columns, row_key, unused
from .text import column_bytes
from .tiles import TILE_ROWS, tiles

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Parts of the fingerprint; all sets of PARTS - MAX_BITS of them are join keys.
PARTS = 7
#: Full-width reference fingerprints, taken from a fixed random sequence.
PIVOTS = np.random.default_rng(64).integers(0, 1 << 64, 16, dtype=np.uint64)
_CHUNK_WORDS = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text: a bit is set if more than half of the shingles' hashes have it.

    Words are separated by ASCII white space, A-Z lower-cased. With fewer words than ``shingle`` the whole sequence is
    the only shingle; without words the fingerprint is zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    width = min(shingle, len(words))
    firsts, lasts = [0, *ends[: len(words) - width]], ends[width - 1 :]
    ones = np.zeros(64, np.int64)
    of = xxhash.xxh64_intdigest
    for at in range(0, len(firsts), _CHUNK_WORDS):
        spans = zip(firsts[at : at + _CHUNK_WORDS], lasts[at : at + _CHUNK_WORDS], strict=True)
        h = np.array([of(joined[s : e - 1], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(firsts), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS, drop: tuple = ()) -> DataFrame:
    """``docs`` with ``simhash`` (bigint, the fingerprint's bits). A null text has the fingerprint of an empty one."""

    def compute(batch: pa.RecordBatch) -> dict:
        offsets, data = column_bytes(batch.column(batch.schema.get_field_index(text)))
        view = memoryview(data)
        found = [fingerprint(bytes(view[a:b]), shingle) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return {"simhash": pa.array(np.array(found, np.uint64).view(np.int64))}

    return add_columns(docs, compute, "simhash bigint", drop)


def _masks(parts: int, alike: int) -> list[int]:
    """The bit masks of all sets of ``alike`` of the ``parts`` parts, as signed 64-bit numbers."""
    edges = [64 * i // parts for i in range(parts + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    masks = [sum(chosen) for chosen in combinations(part, alike)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _coordinates(fingerprints: np.ndarray) -> np.ndarray:
    """The table of distances to all pivots, a row per fingerprint."""
    return np.bitwise_count(fingerprints[:, None] ^ PIVOTS[None, :]).astype(np.int16)


def linked(x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with d(x[i], y[j]) <= max_bits. The pivots' coordinates discard pairs one after the other."""
    i, j = np.nonzero(np.abs(px[:, None, 0] - py[None, :, 0]) <= max_bits)
    for k in range(1, px.shape[1]):
        near = np.abs(px[i, k] - py[j, k]) <= max_bits
        i, j = i[near], j[near]
    near = np.bitwise_count(x[i] ^ y[j]) <= max_bits
    return i[near], j[near]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links (i, j) among n nodes that suffice to connect what all of them connect."""
    parent = list(range(n))

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    kept = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            kept.append((a, b))
    return kept


def _links(tables: Tables, prints: DataFrame, max_bits: int, parts: int, tile_rows: int) -> DataFrame:
    """Links (a, b) between different fingerprints: within each tile enough to connect all that are linked there.

    The rows that are shuffled carry the fingerprint only; a tile's table of pivot distances is computed once, before
    its rows are compared, which is cheaper than shuffling it with every key.
    """
    masks = F.array(*[F.lit(m) for m in _masks(parts, parts - max_bits)])
    key = F.transform(masks, lambda m, i: F.xxhash64(i, F.col("simhash").bitwiseAND(m)))
    keyed = prints.select("simhash", F.explode(key).alias("k"))
    counts = tables.store(keyed.groupBy("k").agg(F.count("*").alias("n_rows")).where("n_rows > 1"))
    dealt = tiles(keyed, counts, F.xxhash64("simhash"), ["simhash"], tile_rows)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("rows")
            flat = lists.flatten()
            x = flat.field("simhash").to_numpy(zero_copy_only=False).view(np.uint64)
            own = flat.field("own").to_numpy(zero_copy_only=False)
            table = _coordinates(x)
            bounds = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            one, two = batch.column("one").to_pylist(), batch.column("two").to_pylist()
            found_a, found_b = [], []
            for g, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                first = np.flatnonzero(own[lo:hi] == one[g]) + lo
                second = first if one[g] == two[g] else np.flatnonzero(own[lo:hi] == two[g]) + lo
                i, j = linked(x[first], table[first], x[second], table[second], max_bits)
                i, j = first[i], second[j]
                i, j = (i[i < j], j[i < j]) if one[g] == two[g] else (i, j)
                if len(i):
                    kept = np.array(forest(hi - lo, i - lo, j - lo), np.int64) + lo
                    found_a.append(x[kept[:, 0]].view(np.int64))
                    found_b.append(x[kept[:, 1]].view(np.int64))
            if found_a:
                columns = [pa.array(np.concatenate(c)) for c in (found_a, found_b)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    links = tables.store(dealt.mapInArrow(pairs, "a bigint, b bigint").distinct())
    tables.drop(counts)
    return links


def _grouped(
    tables: Tables, docs: DataFrame, id_col: str, text: str, shingle: int, max_bits: int, parts: int, tile_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, key, simhash) of all documents, and (simhash, root, component_id) of all fingerprints."""
    narrow = docs.select(F.col(id_col).alias("id"), row_key(id_col, text).alias("key"), F.col(text).alias("text"))
    rows = tables.store(with_fingerprint(narrow, "text", shingle, drop=("text",)))
    prints = tables.store(rows.groupBy("simhash").agg(F.min("id").alias("least")))
    links = _links(tables, prints.select("simhash"), max_bits, parts, tile_rows)
    nodes = components(tables, links)
    rooted = prints.join(nodes, prints["simhash"] == nodes["node"], "left").select(
        "simhash", "least", F.coalesce("root", "simhash").alias("root")
    )
    rooted = tables.store(rooted)
    least = tables.store(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = tables.store(rooted.join(least, "root").select("simhash", "root", "component_id"))
    tables.drop(prints, links, nodes, rooted, least)
    return rows, named


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    parts: int = PARTS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(id_col, simhash bigint, component_id): a row per document, with the least id that links reach from it.

    Documents link if their fingerprints differ in at most ``max_bits`` bits; equal fingerprints are one class and
    are not paired. ``max_bits`` must be less than ``parts``. A null or empty text has fingerprint zero and links like
    any other. A row whose id is null is grouped, but never names a group unless all its ids are null; rows that repeat
    an id keep their own fingerprints. An empty table gives an empty result. Other columns are not read.
    """
    tables = Tables(docs.sparkSession, "simhash")
    rows, named = _grouped(tables, docs, id_col, text, shingle, max_bits, parts, tile_rows)
    return rows.join(named, "simhash").select(F.col("id").alias(id_col), "simhash", "component_id")


def one_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    parts: int = PARTS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """The documents, with all columns, of which each group keeps one: that with the least id, null ids last.

    Among rows with the same least id a hash of the text decides, and of rows that repeat id and text one stays.
    """
    tables = Tables(docs.sparkSession, "simhash")
    rows, named = _grouped(tables, docs, id_col, text, shingle, max_bits, parts, tile_rows)
    first = F.min(F.struct(F.col("id").isNull(), "id", "key"))
    kept = tables.store(rows.join(named, "simhash").groupBy("root").agg(first["key"].alias("key")).select("key"))
    repeated = not rows.groupBy("key").count().where("count > 1").isEmpty()
    tables.drop(rows, named)
    key, place = unused(docs, "_key", "_place")
    found = docs.withColumn(key, row_key(id_col, text)).join(kept.withColumnRenamed("key", key), key, "left_semi")
    if not repeated:
        return found.drop(key)
    numbered = found.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    return numbered.where(F.col(place) == 1).drop(key, place)


def fingerprint_hex(simhash: Column) -> Column:
    """The fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(simhash), 16, "0"))
