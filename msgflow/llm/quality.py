"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network on them.

Random indexing. Every context (a window of consecutive tokens) has a sparse random index vector, drawn from its content;
a word's vector is the sum of the index vectors of all contexts that it occurs in, over the whole corpus. Words share a
table of fixed size by their hashes, so the sums, and what is shipped to the tasks, do not grow with the corpus. A
document's features are the mean of its words' unit vectors and the mean product of neighbouring ones, which shows
repetition. The network is fitted by numpy on a bounded sample; a temperature, fitted on rows that the network has not seen,
calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import labelled_sample, sampled_docs
from .tables import add_columns
from .text import KINDS, blocks, first_of_docs, mixed, runs

#: Rows of the word table, dimensions, non-zero places of an index vector, tokens of a context.
WORD_ROWS, DIMENSIONS, PLACES, CONTEXT = 1 << 14, 32, 4, 32
#: Labelled documents that the network is fitted on, at most.
SAMPLE_ROWS = 12_000
HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 128, 3e-3
_SLOTS = 64


def _contexts(r) -> np.ndarray:
    """The number of each token's context; contexts do not cross documents."""
    new = np.append(True, r.docs[1:] != r.docs[:-1])
    place = np.arange(len(new)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return np.cumsum(new | (place % CONTEXT == 0)) - 1


def _add_contexts(table: np.ndarray, column: pa.Array) -> None:
    """Adds the index vectors of all contexts of a text column to the rows of their words."""
    for block in blocks(column):
        r = runs(block.data, block.offsets, KINDS)
        if not len(r.docs):
            continue
        context = _contexts(r)
        first = first_of_docs(context)
        seed = mixed(np.add.reduceat(r.hashes, first))
        row = (r.hashes % np.uint64(WORD_ROWS)).astype(np.int64) * DIMENSIONS
        for k in range(PLACES):
            draw = mixed(seed + np.uint64(k))
            place = (draw % np.uint64(DIMENSIONS)).astype(np.int64)
            sign = np.where(draw >> np.uint64(63) > 0, 1, -1)
            np.add.at(table, row + place[context], sign[context])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The unit vectors (WORD_ROWS, DIMENSIONS) of all words of the corpus; rows of unseen words are zero.

    Each task sums up its part of the corpus; the parts of a slot of the table are added by one task, row by row of what
    arrives. The driver gets the finished table, whose size is fixed.
    """
    width = WORD_ROWS // _SLOTS * DIMENSIONS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(WORD_ROWS * DIMENSIONS, np.int64)
        for batch in batches:
            _add_contexts(table, batch.column(0))
        parts = table.reshape(_SLOTS, width)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([p.astype("<i4").tobytes() for p in parts[used]], pa.binary())],
            names=["slot", "part"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, part in zip(batch.column("slot").to_pylist(), batch.column("part"), strict=True):
                values = np.frombuffer(part.as_buffer(), "<i4")
                sums[slot] = sums[slot] + values if slot in sums else values.astype(np.int64)
        if sums:
            parts = pa.array([s.astype("<i8").tobytes() for s in sums.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), parts], names=["slot", "part"])

    fields = "slot int, part binary"
    parts = docs.select(F.col(text).alias("text")).mapInArrow(counted, fields).repartition(_SLOTS, "slot")
    table = np.zeros((_SLOTS, width), np.float64)
    for slot, part in parts.mapInArrow(added, fields).collect():
        table[slot] = np.frombuffer(part, "<i8")
    table = table.reshape(WORD_ROWS, DIMENSIONS)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features (documents, 2 * DIMENSIONS + 1): mean vector, mean product of neighbours, and how long the mean is."""
    sums = np.zeros((len(column), 2 * DIMENSIONS))
    counts = np.zeros(len(column))
    for block in blocks(column):
        r = runs(block.data, block.offsets, KINDS)
        if not len(r.docs):
            continue
        v = vectors[(r.hashes % np.uint64(WORD_ROWS)).astype(np.int64)]
        first = first_of_docs(r.docs)
        doc = block.first + r.docs[first]
        sums[doc, :DIMENSIONS] += np.add.reduceat(v, first, axis=0)
        v[1:] *= v[:-1].copy()
        v[first] = 0
        sums[doc, DIMENSIONS:] += np.add.reduceat(v, first, axis=0)
        counts[doc] += np.diff(np.append(first, len(r.docs)))
    means = sums / np.maximum(counts, 1)[:, None]
    return np.column_stack([means, np.linalg.norm(means[:, :DIMENSIONS], axis=1)]).astype(np.float32)


class Network(NamedTuple):
    """Standardisation, two layers, temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def log_loss(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    z = logits / temperature
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Fits the network by Adam on four fifths of the rows and the temperature on the rest.

    With fewer than 20 rows, or labels of one kind, the score is the smoothed share of ones.
    """
    n, width = len(y), x.shape[1]
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if n else (np.zeros(width), np.ones(width))
    ones = int(y.sum())
    if n < 20 or ones in (0, n):
        zero = np.zeros((width, 1))
        return Network(mean, scale, zero, np.zeros(1), np.zeros(1), float(np.log((ones + 1) / (n - ones + 1))), 1.0)
    rng = np.random.default_rng(4)
    order = rng.permutation(n)
    held, used = order[: n // 5], order[n // 5 :]
    z = (x - mean) / scale
    params = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(used)
        for at in range(0, len(used), BATCH):
            rows = used[at : at + BATCH]
            a = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(a @ params[2] + params[3], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - a * a)
            gradients = [z[rows].T @ back + 1e-4 * params[0], back.sum(0), a.T @ error + 1e-4 * params[2], error.sum(keepdims=True)]
            step += 1
            for p, g, m, v in zip(params, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    logits = network.logits(x[held])
    temperatures = np.geomspace(0.25, 8, 61)
    best = min(temperatures, key=lambda t: log_loss(logits, y[held], t))
    return network._replace(temperature=float(best))


class QualityModel(NamedTuple):
    vectors: np.ndarray
    network: Network


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    label: str = "quality",
    id_col: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """A model of ``label`` (0 or 1) from the texts. ``use`` restricts the labels that are learnt from.

    The word vectors count every document; the network sees at most ``sample_rows`` labelled ones.
    """
    vectors = word_vectors(docs, text)
    sample = sampled_docs(docs, labelled_sample(docs, labels, label, sample_rows, use, id_col), text, id_col)

    def features(batch: pa.RecordBatch) -> dict:
        x = pooled(batch.column(batch.schema.get_field_index("text")), vectors)
        return {"x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))}

    rows = sorted(add_columns(sample, features, "x array<float>", drop=("text",)).collect(), key=lambda r: r["id"])
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), 2 * DIMENSIONS + 1)
    return QualityModel(vectors, fit(x, np.array([r["target"] for r in rows], np.float64)))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", drop: tuple = ()) -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1): how likely its label is 1.

    Null and empty texts have the features zero and a score like any other. A text of any length is read whole, block by block. A column named
    ``score`` is replaced; all others stay. Rows that repeat are scored alike, and an empty table gives an empty result.
    """

    def compute(batch: pa.RecordBatch) -> dict:
        x = pooled(batch.column(batch.schema.get_field_index(text)), model.vectors)
        return {"score": pa.array(model.network.scores(x.astype(np.float64)))}

    return add_columns(docs, compute, "score double", drop)
