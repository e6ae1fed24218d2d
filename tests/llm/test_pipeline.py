import numpy as np
import public_tokenizers
import pytest
import test_secrets
import test_simhash
from edge import clashing, edge_rows

import corpus_pipeline
from msgflow.llm import bpe
from msgflow.llm.quality import fit_quality, score_quality
from msgflow.llm.queries import remainder
from msgflow.llm.tables import Tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(300)
    return clashing(given.union(edge_rows(spark)), "_key", "key", "findings", "score", "n_tokens").persist()


def plain_rows(df):
    return sorted(((r.doc_id, r.text, r.lang, r.source) for r in df.collect()), key=repr)


def test_quality_stage_keeps_what_is_scored_high(spark, docs):
    kept = corpus_pipeline.keep_good(spark, docs, SF)
    assert kept.columns == docs.columns
    model = fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"), use=remainder("doc_id", 5) != 0)
    expected = score_quality(docs, model).where("score >= 0.3")
    assert plain_rows(kept) == plain_rows(expected)


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs):
    few = docs.where("length(coalesce(text, '')) < 100000")
    kept = corpus_pipeline.keep_one_of_copies(spark, few, SF)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in few.collect()]
    ids = [(i, t) for i, (_, t) in enumerate(rows)]
    groups = {}
    for i, _, c in test_simhash.plain_groups(ids):
        groups.setdefault(c, []).append(rows[i][0])
    expected = sorted((min(g, key=lambda d: (d is None, d or 0)) for g in groups.values()), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == expected


def test_leak_stage_drops_what_holds_an_item(spark, docs):
    kept = corpus_pipeline.drop_leaks(spark, docs, SF)
    assert kept.columns == docs.columns
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = [r for r in plain_rows(docs) if not any(item in (r[1] or "") for item in items)]
    assert len(expected) < docs.count()
    assert plain_rows(kept) == sorted(expected, key=repr)


def test_secret_stage_replaces_live_credentials(spark, docs):
    cleaned = corpus_pipeline.redact_secrets(spark, docs, SF)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    before = {r.doc_id: r.text for r in docs.collect()}
    owners = {}
    for r in docs.collect():
        for s, _, e, _ in test_secrets.plain_base(r.text):
            owners.setdefault(r.text[s:e], set()).add(r.source)
    changed = 0
    for r in cleaned.collect():
        for s, _, e, _ in test_secrets.plain_base(before[r.doc_id]):
            value = before[r.doc_id][s:e]
            assert (value in r.text) == (len(owners[value]) >= 3)
        changed += r.text != before[r.doc_id] and r.doc_id is not None
        assert r.n_chars == (len(r.text) if r.text is not None else None)
    assert 0 < changed < 40


def test_token_stage_decodes_to_the_texts(spark, docs):
    coded = corpus_pipeline.to_tokens(spark, docs, SF)
    ranks = bpe.Ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    texts = sorted((r.text or "") for r in docs.collect())
    assert sorted(bpe.decode(np.array(r.token_ids, np.int64), ranks).decode() for r in coded.collect()) == texts


def test_run_is_the_stages_one_after_the_other(spark):
    sf = "/root/testdata/sf0.001"
    found = corpus_pipeline.run(spark, sf)
    rows, tables = spark.read.parquet(f"{sf}/documents.parquet"), Tables(spark, "test")
    counts = [rows.count()]
    for _, stage in corpus_pipeline.STAGES:
        rows = tables.store(stage(spark, rows, sf))
        counts.append(rows.count())
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1] > 0.6 * counts[0]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, rows.collect()))


def test_empty_documents(spark, docs):
    rows = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
    assert rows.collect() == []
