"""The registered queries: each operator over its whole table, with the columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import with_tokens
from .decontamination import leaks
from .divergence import source_divergence
from .html import with_main_text
from .langid import fit_languages, with_language
from .quality import fit_quality, score_quality
from .secrets import find_secrets, span_text
from .sharding import shard_rows
from .simhash import fingerprint_hex, simhash_groups
from .tables import shared_folder
from .tokenfile import read_token_files, write_token_files
from .toxicity import fit_toxicity, score_toxicity
from .vectorcodes import vector_codes
from .vectors import near_vectors

SHARDS = 40
#: A document is kept as good from this score on.
QUALITY_CUT = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids have remainder null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, use=remainder("doc_id", 5) != 0)
    scored = score_toxicity(docs, model, drop=("text",))
    return scored.withColumn("toxic", F.col("toxic").cast("int"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    files = write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, folder, files)


def op3_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_rows(docs, SHARDS).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels, use=remainder("doc_id", 5) != 0)
    scored = score_quality(docs, model, drop=("text",))
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return with_tokens(docs, ranks, public_tokenizers.PATTERN, ids=False, drop=("text",))


def op8_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = find_secrets(docs).select("doc_id", "findings")
    of = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")
    base = F.filter("findings", lambda f: f["kind"] != "mixed")
    kept = F.filter("findings", lambda f: (f["kind"] != "mixed") | f["live"])
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(kept).alias("spans"),
        span_text(F.filter("findings", lambda f: f["live"])).alias("live_spans"),
    )


def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs, use=remainder("id", 4) != 2)
    answered = with_language(docs.select("doc_id", "text"), model, drop=("text",))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return answered.select("doc_id", held_out, "lang_pred", "score", "rejected")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = simhash_groups(docs)
    return groups.select("doc_id", fingerprint_hex(F.col("simhash")).alias("fingerprint"), "component_id")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


def op12_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), drop=("html",))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_files": op2_token_files,
    "op3_histogram_shards": op3_histogram_shards,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_near_vectors": op6_near_vectors,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_secret_ownership": op8_secret_ownership,
    "op9_languages": op9_languages,
    "op10_simhash": op10_simhash,
    "op11_vector_codes": op11_vector_codes,
    "op12_html_density": op12_html_density,
    "op13_source_divergence": op13_source_divergence,
}
