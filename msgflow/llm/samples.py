"""Bounded samples of labelled rows, and features that are gathered for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, limit: int, use: Column | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """(id, target) of at most ``limit`` labelled documents, the first by a hash of their id.

    Null ids and targets are left out; of several labels for an id the least counts; ``use`` restricts the labels.
    Only ids take part in the selection, so its size has the bound of ``limit`` narrow rows.
    """
    rows = labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.where(use) if use is not None else rows
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.min(target).alias("target"))
    there = docs.select(F.col(id_col).alias("id")).distinct()
    return rows.join(there, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(limit)


def sampled_docs(docs: DataFrame, sample: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, text, target) of the sample's documents; rows that repeat an id come with the first text only.

    The sample is broadcast: it has at most the documented number of rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    return rows.groupBy("id", "target").agg(F.min("text").alias("text"))
