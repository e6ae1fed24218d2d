"""Near-duplicate embeddings by spherical-cap filters, joined on filters and verified by their cosine.

A filter is a direction; a vector passes it if their inner product exceeds a threshold, that is, if it lies in the cap
around it. Vectors at a small angle are likely to share caps. The filters are structured: a random rotation cuts vectors into
blocks, each block has a random code, and the filters are all combinations of the blocks' code words. So WORDS ** BLOCKS
filters need only WORDS * BLOCKS inner products; list decoding finds those that exceed the threshold by extending
partial sums only as far as the best remaining blocks can still lift them over it. Several such codes, with rotations of their
own, make the filters less alike.

The filters of a label grow with its vectors: twice the code words make four times as many filters, of smaller caps, for four times the vectors. So a
vector is compared with about as many unlike vectors of its label, however many there are. Where vectors have four dimensions or fewer, a constant
share of all pairs are links, and all pairs of a label are compared: there the work is that of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .components import components
from .simhash import forest
from .tables import Tables, add_columns
from .tiles import TILE_ROWS, tiles

COSINE = 0.93
#: Product codes, each with its own rotation; blocks of a code, and code words of a block.
CODES, BLOCKS, WORDS = 8, 2, 64
#: The threshold, in standard deviations of a random unit vector's inner product with a filter. Of pairs of random vectors of
#: 64 dimensions whose cosine is just 0.93, 98 in 100 share a filter; of those with larger cosines, more (tests/llm/test_vectors.py).
DEVIATIONS = 3.1
#: Where fewer than this share of such pairs would share a filter, as in fewer dimensions, the threshold is lower; it is found
#: from so many random pairs.
LEAST_RECALL, _SAMPLE = 0.985, 2000
#: A label has at least so many filters for each of its vectors, up to so many code words (for some 500 million vectors).
FILTERS_PER_VECTOR, MOST_WORDS = 1, 8192
#: The labels with more code words than WORDS, one of some thousands of vectors each, are broadcast up to this many.
BROADCAST_LABELS = 200_000
_ROWS = 512
_PAIRS = 1 << 14


@lru_cache(maxsize=32)
def _codes(dimension: int, code: int, n_words: int = WORDS) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation, and for each block its code words (columns), scaled so that filters are unit vectors."""
    rng = np.random.default_rng([6, code, dimension])
    rotation, _ = np.linalg.qr(rng.normal(size=(dimension, dimension)))
    edges = [dimension * b // BLOCKS for b in range(BLOCKS + 1)]
    codes = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        words = rng.normal(size=(b - a, n_words))
        norms = np.linalg.norm(words, axis=0) if b > a else np.ones(n_words)
        codes.append(words / norms / BLOCKS**0.5)
    return rotation, codes


def _products(x: np.ndarray, code: int) -> np.ndarray:
    """Inner products of unit vectors with all filters of a code."""
    rotation, codes = _codes(x.shape[1], code)
    turned, out, at = x @ rotation, np.zeros((len(x), 1)), 0
    for c in codes:
        out = (out[:, :, None] + (turned[:, at : at + len(c)] @ c)[:, None, :]).reshape(len(x), -1)
        at += len(c)
    return out


def _pairs_at(dimension: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors with this cosine."""
    rng = np.random.default_rng([7, dimension])
    a, other = unit(rng.normal(size=(_SAMPLE, dimension))), rng.normal(size=(_SAMPLE, dimension))
    other = unit(other - (other * a).sum(axis=1, keepdims=True) * a)
    return a, cosine * a + max(0.0, 1 - cosine**2) ** 0.5 * other


@lru_cache(maxsize=32)
def deviations_for(dimension: int, cosine: float, n_words: int = WORDS) -> float:
    """The largest threshold by which LEAST_RECALL of pairs that have just this cosine share a filter; with WORDS code words DEVIATIONS at most.

    It is minus infinity, for one filter that all vectors pass, where vectors would pass so many filters that comparing all
    with all is no more work.
    """
    if dimension < 3:
        return -np.inf
    if n_words > WORDS:
        return _more_deviations(dimension, cosine, n_words)
    a, b = _pairs_at(dimension, cosine)
    parts = [slice(at, at + _ROWS // 2) for at in range(0, _SAMPLE, _ROWS // 2)]
    shared = [
        np.max([np.minimum(_products(a[part], code), _products(b[part], code)).max(axis=1) for code in range(CODES)], axis=0)
        for part in parts
    ]
    least = min(float(np.quantile(np.concatenate(shared), 1 - LEAST_RECALL)), DEVIATIONS / dimension**0.5)
    passed = np.mean([(_products(a[parts[0]], code) >= least).sum(axis=1).mean() for code in range(CODES)]) * CODES
    return least * dimension**0.5 if passed**2 < CODES * WORDS**BLOCKS else -np.inf


def _more_deviations(dimension: int, cosine: float, n_words: int) -> float:
    """The threshold with more code words, above that with half as many: only filters that pass the lower one are looked at."""
    lower = deviations_for(dimension, cosine, n_words // 2)
    if lower == -np.inf:
        return lower
    a, b = _pairs_at(dimension, cosine)
    best = np.full(len(a), -np.inf)
    rows = _rows_at_once(n_words)
    for at in range(0, len(a), rows):
        left, right = a[at : at + rows], b[at : at + rows]
        for code in range(CODES):
            row, filter_ = _decoded(left, lower, code, n_words)
            both = [_at_filters(x, code, n_words, row, filter_) for x in (left, right)]
            np.maximum.at(best, at + row, np.minimum(*both))
    least = float(np.quantile(best, 1 - LEAST_RECALL, method="lower"))
    return max(lower, least * dimension**0.5)


def _at_filters(x: np.ndarray, code: int, n_words: int, row: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """The inner products of rows of ``x`` with filters of a code."""
    rotation, codes = _codes(x.shape[1], code, n_words)
    turned, total, at = x @ rotation, np.zeros(len(row)), 0
    for b, c in enumerate(codes):
        word = filter_ // n_words ** (BLOCKS - 1 - b) % n_words
        total += (turned[:, at : at + len(c)] @ c)[row, word]
        at += len(c)
    return total


def _rows_at_once(n_words: int) -> int:
    """Vectors decoded at once, so that the partial sums of a block have a bound."""
    return int(np.clip((1 << 26) // n_words**2, 1, _ROWS))


def passed_filters(x: np.ndarray, deviations: float = DEVIATIONS, n_words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters of all codes that the unit vectors ``x`` pass, by row and filter."""
    found = [_decoded(x, deviations, code, n_words) for code in range(CODES)]
    row = np.concatenate([r for r, _ in found])
    filter_ = np.concatenate([f + code * n_words**BLOCKS for code, (_, f) in enumerate(found)])
    order = np.lexsort((filter_, row))
    return row[order], filter_[order]


def _decoded(x: np.ndarray, deviations: float, code: int, n_words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    n, dimension = x.shape
    rotation, codes = _codes(dimension, code, n_words)
    threshold = deviations / dimension**0.5
    turned = x @ rotation
    edges = np.cumsum([0, *(len(c) for c in codes)])
    products = [turned[:, a:b] @ c for a, b, c in zip(edges[:-1], edges[1:], codes, strict=True)]
    reach = np.cumsum([p.max(axis=1) for p in products[::-1]], axis=0)[::-1]  # what blocks from here on can add
    row, filter_, total = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
    for b, product in enumerate(products):
        rest = reach[b + 1][row] if b + 1 < BLOCKS else np.zeros(len(row))
        extended = total[:, None] + product[row]
        at, word = np.nonzero(extended + rest[:, None] >= threshold)
        total, filter_, row = extended[at, word], filter_[at] * n_words + word, row[at]
    return row, filter_


def _matrix(binary: pa.Array, single: bool) -> np.ndarray:
    """Vectors of one dimension as a matrix of doubles."""
    flat = np.frombuffer(b"".join(binary.to_pylist()), "<f4" if single else "<f8").astype(np.float64)
    return flat.reshape(len(binary), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, which keeps squares finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _with_bytes(rows: DataFrame, single: bool) -> DataFrame:
    """``rows`` with ``vec``: the components' bytes, or null for vectors that link with nothing."""
    kind = "<f4" if single else "<f8"

    def compute(batch: pa.RecordBatch) -> dict:
        out = []
        for v in batch.column("vector"):
            values = v.values
            if values is None or values.null_count or not len(values):
                out.append(None)
                continue
            x = np.asarray(values, kind) + 0.0  # -0.0 becomes 0.0
            out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        return {"vec": pa.array(out, pa.binary())}

    return add_columns(rows, compute, "vec binary", drop=("vector",))


def words_for(n: Column) -> Column:
    """The code words for a label of n vectors: WORDS, or the least power of two that gives FILTERS_PER_VECTOR filters for each."""
    words = F.pow(2, F.ceil(F.log2(F.pow(n * FILTERS_PER_VECTOR / CODES, 1 / BLOCKS))))
    return F.least(F.greatest(words, F.lit(WORDS)), F.lit(MOST_WORDS)).cast("int")


def _with_words(classes: DataFrame, tables: Tables) -> DataFrame:
    """``classes`` with ``words``: the code words for the vectors of its label."""
    many = classes.groupBy("label").agg(words_for(F.count("*")).alias("words")).where(F.col("words") > WORDS)
    many = tables.store(many)
    many = F.broadcast(many) if many.count() <= BROADCAST_LABELS else many
    return classes.join(many, "label", "left").withColumn("words", F.coalesce("words", F.lit(WORDS)))


def _with_filters(classes: DataFrame, single: bool, cosine: float, deviations: float | None) -> DataFrame:
    """``classes`` with ``filters``: those that the vector passes, ascending."""
    width = 4 if single else 8

    def compute(batch: pa.RecordBatch) -> dict:
        vec = batch.column(batch.schema.get_field_index("vec"))
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(vec)
        sizes = np.array([len(v.as_buffer()) // width for v in vec])
        levels = batch.column(batch.schema.get_field_index("words")).to_numpy()
        for dimension, n_words in np.unique(np.stack([sizes, levels], 1), axis=0).tolist():
            mine = np.flatnonzero((sizes == dimension) & (levels == n_words))
            threshold = deviations_for(dimension, cosine, n_words) if deviations is None else deviations
            if threshold == -np.inf:
                for i in mine.tolist():
                    found[i] = np.zeros(1, np.int32)
                continue
            rows = _rows_at_once(n_words)
            for at in range(0, len(mine), rows):
                some = mine[at : at + rows]
                row, filter_ = passed_filters(unit(_matrix(vec.take(pa.array(some)), single)), threshold, n_words)
                parts = np.split(filter_.astype(np.int32), np.searchsorted(row, np.arange(1, len(some))))
                for i, part in zip(some.tolist(), parts, strict=True):
                    found[i] = np.sort(part)
        return {"filters": pa.array(found, pa.list_(pa.int32()))}

    return add_columns(classes, compute, "filters array<int>", drop=("words",))


def first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of ascending filters, padded by -1 and -2: the least filter that both rows have."""
    same = a[:, :, None] == b[:, None, :]
    return np.where(same.any(axis=2), a, np.iinfo(a.dtype).max).min(axis=1)


def _padded(lists: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(lists), max(map(len, lists))), fill, np.int32)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _links(filtered: DataFrame, tables: Tables, single: bool, cosine: float, tile_rows: int) -> DataFrame:
    """(a, b, links): either links of node a (b is null) to be added up, or a link of a and b that connects them.

    A pair that several filters bring together counts at the least of them only.
    """
    keyed = filtered.select("node", "n", "vec", "filters", F.explode("filters").alias("filter"), "label")
    key = F.struct("label", F.octet_length("vec").alias("width"), "filter")
    keyed = keyed.withColumn("k", key)
    counts = tables.store(keyed.groupBy("k").agg(F.count("*").alias("n_rows")).where("n_rows > 1"))
    dealt = tiles(keyed.drop("label", "filter"), counts, F.xxhash64("node"), ["node", "n", "vec", "filters"], tile_rows)

    def group(rows: pa.StructArray, one: int, two: int, filter_: int) -> tuple[list, list, list]:
        own = rows.field("own").to_numpy(zero_copy_only=False)
        node, n = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "n"))
        x = unit(_matrix(rows.field("vec"), single))
        first = np.flatnonzero(own == one)
        second = first if one == two else np.flatnonzero(own == two)
        i, j = np.nonzero(x[first] @ x[second].T >= cosine)
        i, j = first[i], second[j]
        i, j = (i[i < j], j[i < j]) if one == two else (i, j)
        if not len(i):
            return [], [], []
        lists = rows.field("filters")
        lists = [np.asarray(lists[k].values) for k in range(len(rows))]
        left, right = _padded(lists, -1), _padded(lists, -2)
        mine = np.concatenate(
            [first_common(left[i[s : s + _PAIRS]], right[j[s : s + _PAIRS]]) == filter_ for s in range(0, len(i), _PAIRS)]
        )
        links = np.bincount(i[mine], n[j[mine]], len(node)) + np.bincount(j[mine], n[i[mine]], len(node))
        some = np.flatnonzero(links)
        kept = np.array(forest(len(node), i, j), np.int64).reshape(-1, 2)
        a = [*node[some].tolist(), *node[kept[:, 0]].tolist()]
        b = [*([None] * len(some)), *node[kept[:, 1]].tolist()]
        return a, b, [*links[some].astype(np.int64).tolist(), *([0] * len(kept))]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = [], [], []
            filters = batch.column("k").field("filter").to_pylist()
            one, two = batch.column("one").to_pylist(), batch.column("two").to_pylist()
            for g in range(batch.num_rows):
                for whole, part in zip(out, group(batch.column("rows")[g].values, one[g], two[g], filters[g]), strict=True):
                    whole += part
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b", "links"])

    found = tables.store(dealt.mapInArrow(compare, "a bigint, b bigint, links bigint"))
    tables.drop(counts)
    return found


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    deviations: float | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(id_col, n_links, component_id, kept): a row per vector, compared with the vectors of the same label.

    ``n_links`` counts other rows whose cosine, in double precision, is at least ``cosine``; ``component_id`` is the least
    id that links reach; ``kept`` is whether that is the row's own. Equal vectors of a label are one class: they link with each
    other and are compared once. Rows whose label is null, and vectors that are null, empty, zero or hold null or
    non-finite components, link with nothing. Vectors of different dimensions do not link. A null id is grouped, but
    names a group only where no id is there; then ``kept`` is false. An empty table gives an empty result. Other columns are
    not read. No pair under ``cosine`` links; a pair above it is missed only if it shares no filter.
    ``deviations`` is the threshold of all filters; by default it follows from the dimension and ``cosine``.
    """
    kind = vectors.schema[vector].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    tables = Tables(vectors.sparkSession, "vectors")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    if not single:
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    rows = tables.store(_with_bytes(rows, single))
    usable = F.col("vec").isNotNull() & F.col("label").isNotNull()
    classes = rows.where(usable).groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = tables.store(classes.withColumn("node", F.coalesce("least", F.xxhash64("label", "vec"))))
    filtered = tables.store(_with_filters(_with_words(classes.select("node", "n", "label", "vec"), tables), single, cosine, deviations))
    found = _links(filtered, tables, single, cosine, tile_rows)
    nodes = components(tables, found.where("b is not null").select("a", "b"))
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    named = (
        classes.join(nodes, "node", "left")
        .join(links, F.col("node") == F.col("a"), "left")
        .select("label", "vec", "least", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    )
    named = tables.store(named)
    least = tables.store(named.groupBy("root").agg(F.min("least").alias("component_id")))
    answers = named.join(least, "root").select(
        "label", "vec", "component_id", (F.col("links") + F.col("n") - 1).alias("n_links")
    )
    answers = tables.store(answers)
    tables.drop(classes, filtered, found, nodes, named, least)
    linked = rows.join(answers, ["label", "vec"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return linked.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
