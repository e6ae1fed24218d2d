"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns the columns of documents, except
for the last. Rows are told apart by id and text, so null and repeated ids do not mix rows up.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.llm.bpe import with_tokens
from msgflow.llm.decontamination import leaks
from msgflow.llm.quality import fit_quality, score_quality
from msgflow.llm.queries import QUALITY_CUT, remainder, table
from msgflow.llm.secrets import find_secrets, redacted
from msgflow.llm.simhash import one_of_each_group
from msgflow.llm.tables import Tables, row_key, unused


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of four fifths of the ids.

    A null or empty text has a score like any other and is kept if that reaches the cut; a row with a null id teaches nothing and is scored. Texts
    are scored whole, rows that repeat alike; an empty table stays empty, and further columns are kept.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"), use=remainder("doc_id", 5) != 0)
    return score_quality(docs, model).where(F.col("score") >= QUALITY_CUT).select(*docs.columns)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates.

    Null and empty texts, and texts without words, are one group. Of rows that repeat one stays; an id that is null counts as the largest. Texts
    of any length are compared whole.
    """
    return one_of_each_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item.

    Rows are told apart by id and text, so a null or repeated id takes no other row along. Null and empty texts hold nothing; an empty benchmark
    drops nothing. Texts of any length are searched whole.
    """
    (key,) = unused(docs, "_key")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    leaked = leaks(keyed, table(spark, sf_dir, "benchmark"), id_col=key).select(key).distinct()
    return keyed.join(leaked, key, "left_anti").drop(key)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials replaced by a mark; widely copied examples stay as they are.

    A null text stays null, with a null ``n_chars``; an empty one is unchanged. Rows that repeat are redacted alike.
    """
    live = F.filter("findings", lambda f: f["live"])
    clean = find_secrets(docs).withColumn("text", redacted(F.col("text"), live))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents, with their digests, in place of the texts; a null text has no ids, like an empty one."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return with_tokens(docs, ranks, public_tokenizers.PATTERN, drop=("text",))


STAGES = [
    ("quality", keep_good),
    ("near-duplicates", keep_one_of_copies),
    ("benchmark leaks", drop_leaks),
    ("secrets", redact_secrets),
    ("tokens", to_tokens),
]

#: Classifier, alignment and merges are beyond SQL; tests/llm/test_pipeline.py compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents of ``sf_dir``."""
    tables = Tables(spark, "pipeline")
    docs, stored = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES:
        docs = tables.store(stage(spark, docs, sf_dir))
        if stored:
            tables.drop(stored.pop())
        stored.append(docs)
    return docs
