"""Language ID: averaged embeddings of hashed subwords, a linear softmax, and calibrated rejection.

A document's features are its words and the runs of three and four bytes of its normalised text, each hashed to a row
of an embedding table of fixed size. Their average goes through a linear softmax. Table and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample of documents. For scoring, table and softmax are multiplied
once, so that a feature adds one number per language.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import labelled_sample, sampled_docs
from .tables import add_columns, unused, without
from .text import WORDS, blocks, first_of_docs, lowered, mixed, runs

ROWS, DIMENSIONS = 1 << 14, 16
#: Documents that are learnt from, at most.
SAMPLE_ROWS = 4_000
#: Passes, documents of a step, and the first step widths of the softmax and of the table. A feature has a small share of
#: its document, and so of the gradient: the table's steps are wider.
EPOCHS, BATCH, RATE, TABLE_RATE = 8, 16, 0.5, 50.0
#: Of the documents that a score under the rejection threshold is to leave out, the share that is wrong at least.
REJECT_PRECISION = 0.99
UNDEFINED = "und"


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, row) of each feature of a block, documents ascending: words, and runs of 3 and 4 bytes."""
    low = lowered(data)
    words = runs(low, offsets, WORDS)
    plain = np.where(WORDS[low] > 0, low, 32).astype(np.uint64)
    docs, rows = [words.docs], [(words.hashes % np.uint64(ROWS)).astype(np.int32)]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in (3, 4):
        if len(plain) < n:
            continue
        m = len(plain) - n + 1
        gram = np.zeros(m, np.uint64)
        for k in range(n):
            gram = gram << np.uint64(8) | plain[k : k + m]
        inside = (owner[:m] == owner[n - 1 :]) & (plain[1 : 1 + m] != 32)
        docs.append(owner[:m][inside])
        rows.append((mixed(gram[inside] + np.uint64(n)) % np.uint64(ROWS)).astype(np.int32))
    doc, row = np.concatenate(docs), np.concatenate(rows)
    order = np.argsort(doc, kind="stable")
    return doc[order], row[order]


class LanguageModel(NamedTuple):
    """Languages, the product of table and softmax, its bias, the temperature, and the score to be rejected under."""

    languages: list[str]
    weights: np.ndarray  # (languages, ROWS)
    bias: np.ndarray
    temperature: float
    threshold: float


def probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit_embeddings(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (n, ROWS) and bias of n languages, from (rows, shares) of each document."""
    rng = np.random.default_rng(9)
    table = rng.normal(0, 1 / DIMENSIONS, (ROWS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, DIMENSIONS**-0.5, (DIMENSIONS, n)).astype(np.float32)
    bias = np.zeros(n, np.float32)
    order = np.arange(len(docs))
    for epoch in range(EPOCHS):
        slower = 1 - epoch / EPOCHS
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            rows = np.concatenate([docs[i][0] for i in batch])
            shares = np.concatenate([docs[i][1] for i in batch])[:, None]
            sizes = np.array([len(docs[i][0]) for i in batch])
            mean = np.add.reduceat(table[rows] * shares, np.cumsum(sizes) - sizes, axis=0)
            error = probabilities(mean @ softmax + bias)
            error[np.arange(len(batch)), y[batch]] -= 1
            back = error @ softmax.T
            softmax -= RATE * slower / len(batch) * (mean.T @ error)
            bias -= RATE * slower / len(batch) * error.sum(0)
            np.add.at(table, rows, -TABLE_RATE * slower * np.repeat(back, sizes, axis=0) * shares)
    return np.ascontiguousarray((table @ softmax).T, np.float32), bias


def fit_languages(
    docs: DataFrame,
    use: Column | None = None,
    lang: str = "lang",
    id_col: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """A model of the non-null values of ``lang``, from at most ``sample_rows`` of the documents that ``use`` admits.

    The sample is gathered as counts of hashed features, so a document takes at most ROWS numbers whatever its length.
    A fifth of the sample is kept back to fit the temperature and the rejection threshold: the least score of which those
    at or above it are right in REJECT_PRECISION of the cases. Without any document the model knows ``und`` only.
    """
    labels = docs.select(F.col(id_col).alias("id"), F.col(lang).alias("target"))
    chosen = labelled_sample(docs.select(F.col(id_col).alias("id")), labels, "target", sample_rows, use, "id")
    sample = sampled_docs(docs, chosen, text, id_col)

    def features(batch: pa.RecordBatch) -> dict:
        rows, counts = [], []
        texts = batch.column(batch.schema.get_field_index("text"))
        for i in range(len(texts)):
            total = np.zeros(ROWS, np.int64)
            for block in blocks(texts.slice(i, 1)):
                total += np.bincount(subwords(block.data, block.offsets)[1], minlength=ROWS)
            rows.append(np.flatnonzero(total).astype(np.int32))
            counts.append((total[rows[-1]] / max(1, total.sum())).astype(np.float32))
        return {"rows": pa.array(rows, pa.list_(pa.int32())), "shares": pa.array(counts, pa.list_(pa.float32()))}

    table = add_columns(sample, features, "rows array<int>, shares array<float>", drop=("text",)).toArrow().sort_by("id")
    languages = sorted(set(table["target"].to_pylist()))
    y = np.array([languages.index(t) for t in table["target"].to_pylist()], np.int64)
    data = [(np.array(r.values), np.array(s.values)) for r, s in zip(table["rows"], table["shares"], strict=True)]
    there = [i for i, (r, _) in enumerate(data) if len(r)]
    data, y = [data[i] for i in there], y[there]
    if not data:
        return LanguageModel([UNDEFINED], np.zeros((1, ROWS), np.float32), np.zeros(1), 1.0, 0.0)
    held = np.arange(len(data)) % 5 == 0 if len(data) >= 50 else np.zeros(len(data), bool)
    weights, bias = _fit_embeddings([d for d, h in zip(data, held, strict=True) if not h], y[~held], len(languages))
    model = LanguageModel(languages, weights, bias, 1.0, 0.0)
    if not held.any():
        return model
    logits = np.array([weights[:, r] @ s + bias for (r, s), h in zip(data, held, strict=True) if h], np.float64)
    answer = y[held]

    def loss(t: float) -> float:
        return -np.mean(np.log(probabilities(logits / t)[np.arange(len(answer)), answer] + 1e-12))

    temperature = float(min(np.geomspace(0.1, 10, 61), key=loss))
    p = probabilities(logits / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == answer
    order = np.argsort(-score)
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= REJECT_PRECISION
    threshold = float(score[order][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    return model._replace(temperature=temperature, threshold=threshold)


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", drop: tuple = ()) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its calibrated probability) and ``rejected`` (score under the threshold).

    A text that is null or has no letter has ``und``, score 0, and is rejected. Columns of those names are replaced; all
    others stay; ``drop`` names columns to leave out. Rows that repeat are answered alike, an empty table gives an empty result, and a text of any
    length is read whole, block by block.
    """
    rows = without(docs, ["lang_pred", "score", "rejected"])
    (letters,) = unused(rows, "_letters")
    rows = rows.withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    names = pa.array([*model.languages, UNDEFINED])

    def compute(batch: pa.RecordBatch) -> dict:
        column = batch.column(batch.schema.get_field_index(text))
        sums, counts = np.zeros((len(column), len(model.languages))), np.zeros(len(column))
        for block in blocks(column):
            doc, row = subwords(block.data, block.offsets)
            if len(doc):
                first = first_of_docs(doc)
                at = block.first + doc[first]
                counts[at] += np.diff(np.append(first, len(doc)))
                for k, weights in enumerate(model.weights):
                    sums[at, k] += np.add.reduceat(weights[row], first, dtype=np.float64)
        p = probabilities((sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
        there = batch.column(batch.schema.get_field_index(letters)).to_numpy(zero_copy_only=False)
        best = np.where(there, p.argmax(axis=1), len(model.languages))
        score = np.where(there, p.max(axis=1), 0.0)
        rejected = ~there | (score < model.threshold)
        return {"lang_pred": pc.take(names, pa.array(best)), "score": score, "rejected": rejected}

    return add_columns(rows, compute, "lang_pred string, score double, rejected boolean", (*drop, letters))
