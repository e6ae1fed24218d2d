"""Toxicity: cumulative-link ordinal regression of severity grades on sparse word features.

Grades. Labels say toxic or not, so the grades to learn from are made: words that occur in many toxic documents of the sample and hardly
elsewhere are markers, and the number of markers in a toxic document sorts it into grade 1, 2 or 3; grade 0 is not toxic. The sample is cut into
folds, and a document is graded by the markers of the other folds, so its own words do not make themselves markers.

Model. P(grade > k) = sigmoid(w x - theta_k): one weight vector for all ordered thresholds theta_1 <= theta_2 <= theta_3. The
features are the logarithms of 1 + the counts of words, hashed to a table of fixed size; an L1 penalty keeps the weights of
words that say nothing at zero, so long texts do not add up noise. The expected severity is the sum of P(grade > k). Cuts of the expected
severity, each with the best F1 for its grade, make the predicted grade, and a document is toxic from grade 1 on.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .quality import SAMPLE_ROWS
from .samples import labelled_sample, sampled_docs
from .tables import add_columns
from .text import WORDS, blocks, lowered, runs

ROWS = 1 << 18
#: Markers: in so many toxic documents at least, and of all documents with the word such a share is toxic.
MARKER_DOCS, MARKER_SHARE = 5, 0.7
#: From so many markers on a toxic document has grade 2, and grade 3.
GRADE_MARKERS = (2, 4)
GRADES = 3
FOLDS = 5
ROUNDS, PENALTY, RATE = 300, 2e-4, 0.3


class ToxicityModel(NamedTuple):
    """Weights of hashed words, ordered thresholds, and the expected severities from which on a document has grade 1, 2 and 3."""

    weights: np.ndarray
    thresholds: np.ndarray
    cuts: np.ndarray


def _word_counts(column: pa.Array, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, row, count) of the hashed words of a text column; ``only`` marks the rows of interest."""
    found = []
    for block in blocks(column):
        r = runs(lowered(block.data), block.offsets, WORDS)
        row = (r.hashes % np.uint64(ROWS)).astype(np.int64)
        keep = only[row] if only is not None else slice(None)
        found.append((block.first + r.docs[keep]) * ROWS + row[keep])
    keys, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    return keys // ROWS, keys % ROWS, counts


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def expected_severity(eta: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    return sigmoid(eta[:, None] - thresholds[None, :]).sum(axis=1)


def grades(doc: np.ndarray, row: np.ndarray, count: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Severity grades of documents with word counts and labels, each by the markers of the other folds."""
    fold = np.arange(len(toxic)) % FOLDS
    n = np.zeros(len(toxic))
    for f in range(FOLDS):
        others = fold[doc] != f
        in_toxic = np.bincount(row[others], toxic[doc[others]], ROWS)
        in_all = np.bincount(row[others], minlength=ROWS)
        marker = (in_toxic >= MARKER_DOCS) & (in_toxic >= MARKER_SHARE * in_all)
        mine = ~others
        n += np.bincount(doc[mine], count[mine] * marker[row[mine]], len(toxic))
    return np.where(toxic > 0, 1 + sum((n >= m).astype(np.int64) for m in GRADE_MARKERS), 0)


def fit_ordinal(doc: np.ndarray, row: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the cumulative-link loss with an L1 penalty, by proximal adaptive steps."""
    n = len(y)
    rows, place = np.unique(row, return_inverse=True)
    w, slopes = np.zeros(len(rows)), np.full(len(rows), 1e-8)
    share = np.clip([(y > k).mean() for k in range(GRADES)], 1 / (n + 2), 1 - 1 / (n + 2))
    theta = np.log((1 - share) / share)
    theta_slopes = np.full(GRADES, 1e-8)
    for _ in range(ROUNDS):
        eta = np.bincount(doc, w[place] * x, n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = sigmoid(edge[y + 1] - eta), sigmoid(edge[y] - eta)
        p = np.maximum(upper - lower, 1e-12)
        slope = (upper * (1 - upper) - lower * (1 - lower)) / p / n  # of the loss, by eta
        gradient = np.bincount(place, slope[doc] * x, len(rows))
        slopes += gradient**2
        step = RATE / np.sqrt(slopes)
        w -= step * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - step * PENALTY, 0)
        down = np.zeros(GRADES + 2)
        np.add.at(down, y + 1, -upper * (1 - upper) / p / n)
        np.add.at(down, y, lower * (1 - lower) / p / n)
        theta_slopes += down[1:-1] ** 2
        theta = np.maximum.accumulate(theta - RATE * down[1:-1] / np.sqrt(theta_slopes))
    weights = np.zeros(ROWS)
    weights[rows] = w
    return weights, theta


def best_cut(severity: np.ndarray, toxic: np.ndarray) -> float:
    """The severity that parts toxic from other documents with the best F1."""
    order = np.argsort(-severity, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    last = np.append(severity[order][1:] != severity[order][:-1], True)
    k = int(np.argmax(np.where(last, f1, -1)))
    below = severity[order][k + 1] if k + 1 < len(order) else 0.0
    return float((severity[order][k] + below) / 2)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    label: str = "toxic",
    id_col: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """A model of ``label`` (0 or 1) from at most ``sample_rows`` labelled documents that ``use`` admits.

    Without toxic or without other documents all severities are the share of toxic ones, and nothing is flagged.
    """
    sample = sampled_docs(docs, labelled_sample(docs, labels, label, sample_rows, use, id_col), text, id_col)

    def features(batch: pa.RecordBatch) -> dict:
        doc, row, count = _word_counts(batch.column(batch.schema.get_field_index("text")))
        ends = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (row, count)]
        return dict(zip(("rows", "counts"), lists, strict=True))

    fields = "rows array<int>, counts array<int>"
    table = add_columns(sample, features, fields, drop=("text",)).toArrow().sort_by("id").combine_chunks()
    toxic = np.array(table["target"].to_pylist(), np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        share = toxic.mean() if len(toxic) else 0.0
        theta = np.full(GRADES, np.log((1 - share * 0.999 + 1e-3) / (share + 1e-3)))
        return ToxicityModel(np.zeros(ROWS), theta, np.full(GRADES, np.inf))
    sizes = np.array([len(r) for r in table["rows"]], np.int64)
    doc = np.repeat(np.arange(len(toxic)), sizes)
    row, count = (np.concatenate([np.asarray(v.values) for v in table[c]]) for c in ("rows", "counts"))
    y = grades(doc, row, count, toxic)
    often = np.bincount(row, minlength=ROWS)[row] >= 3
    doc, row, x = doc[often], row[often], np.log1p(count[often])
    weights, theta = fit_ordinal(doc, row, x, y)
    eta = np.bincount(doc, weights[row] * x, len(y))
    severity = expected_severity(eta, theta)
    cuts = [best_cut(severity, (y > k).astype(np.int64)) if (y > k).any() else np.inf for k in range(GRADES)]
    return ToxicityModel(weights, theta, np.maximum.accumulate(cuts))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", drop: tuple = ()) -> DataFrame:
    """``docs`` with ``severity`` (double, the expected grade 0 to 3), ``grade`` (0 to 3) and ``toxic`` (boolean).

    The grade follows from the severity, and ``toxic`` is true from grade 1 on. A null or empty text has no features: its severity is that of the
    thresholds alone. A text of any length is read whole, block by block. Columns of those names are
    replaced; all others stay; rows that repeat are scored alike; an empty table gives an empty result.
    """
    used = model.weights != 0
    rows = np.flatnonzero(used)
    values, thresholds, cuts = model.weights[rows], model.thresholds, model.cuts

    def compute(batch: pa.RecordBatch) -> dict:
        only = np.zeros(ROWS, bool)
        only[rows] = True
        weights = np.zeros(ROWS)
        weights[rows] = values
        doc, row, count = _word_counts(batch.column(batch.schema.get_field_index(text)), only)
        eta = np.bincount(doc, weights[row] * np.log1p(count), batch.num_rows)
        severity = expected_severity(eta, thresholds)
        grade = (severity[:, None] >= cuts[None, :]).sum(axis=1).astype(np.int32)
        return {"severity": severity, "grade": grade, "toxic": grade > 0}

    return add_columns(docs, compute, "severity double, grade int, toxic boolean", drop)
