"""The audit of sources against a plain version, and the run-length columns it computes on."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from msgflow.llm.divergence import probabilities, run_difference, source_divergence, term_counts

from edge import rows_of, with_edges

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows, least_docs=30, top=50):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows, term by term and pair by pair."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {lang for lang, _ in counts}:
        terms = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        groups = {s: counts[g, s] for g, s in counts if g == lang}
        whole = sum(groups.values(), Counter())

        def p(counter):
            total = sum(counter[t] for t in terms)
            return {t: 1 + 10**9 * (counter[t] + 5) // (total + 5 * len(terms)) for t in terms}

        q, ps = p(whole), {s: p(c) for s, c in groups.items()}
        for s, own in ps.items():
            pairs = [(-sum(abs(own[t] - other[t]) for t in terms), o.encode()) for o, other in ps.items() if o != s]
            likely = [(q[t] - own[t], t.encode()) for t in terms if groups[s][t] and own[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(likely)[:top])):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out, key=repr)


NAMES = ("lang", "source", "part", "item", "value", "rank")


def audit(df, **options):
    return rows_of(source_divergence(df, **options), *NAMES)


def triples(df):
    return [tuple(r) for r in df.select("lang", "source", "text").collect()]


def test_whole_table_with_edge_rows(spark, sf_dir):
    docs = with_edges(spark, sf_dir)
    assert audit(docs) == plain_audit(triples(docs))


@pytest.mark.parametrize("options", [{"block_terms": 7, "tile_sources": 2}, {"block_terms": 1, "tile_sources": 100}, {"tile_sources": 3}])
def test_blocks_and_tiles_do_not_matter(spark, sf_dir, options):
    docs = with_edges(spark, sf_dir).where("length(text) < 100000 or text is null")
    assert audit(docs, least_docs=2, **options) == plain_audit(triples(docs), least_docs=2)


def test_without_broadcasts(spark, sf_dir, monkeypatch):
    from msgflow.llm import divergence

    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert audit(docs) == plain_audit(triples(docs))


def test_counts_are_passed_on_and_texts_cut(spark):
    docs = spark.createDataFrame(
        [("en", "a", "One two one THREE Ärger ärger x1y"), ("en", "a", "two two"), (None, None, "aé" * 50), ("", "", None)],
        "lang string, source string, text string",
    )
    for options in ({}, {"task_counts": 1}, {"piece_bytes": 3}):
        found = term_counts(docs.fillna("", ["lang", "source"]).coalesce(1), **options)
        sums = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        assert rows_of(sums) == sorted(
            [("en", "a", t, n, d) for t, n, d in [("one", 2, 1), ("two", 3, 2), ("three", 1, 1), ("Ärger", 1, 1), ("ärger", 1, 1), ("x", 1, 1), ("y", 1, 1)]]
            + [("", "", "aé" * 50, 1, 1)],
            key=repr,
        )


def test_languages_without_kept_terms_and_single_sources(spark):
    rows = [("en", "a", "word"), ("en", "b", None), ("fr", "a", ""), (None, "x", "1 2"), (None, None, "3")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns(
        {name: F.lit("own") for name in ("n", "term", "p", "v", "place", "rank", "doc_id")}
    )
    assert audit(docs) == plain_audit(rows)
    assert [r for r in audit(docs) if r[0] == "en"] == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert audit(docs.where("false")) == []


def test_ties_go_by_the_items_bytes(spark):
    rows = [("en", s, "same words here éa za") for s in ("b", "é", "a", "z") for _ in range(3)] + [("en", "c", "za éa za éa")] * 3
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert audit(docs, least_docs=3) == plain_audit(rows, least_docs=3)



@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=60))
def test_runs_give_the_same_sum_as_terms(pairs):
    def runs(column):
        column = np.array(column, np.int64)
        starts = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
        return starts, probabilities(column[starts], int(column.sum()), len(column))

    (a, pa), (b, pb) = runs([x for x, _ in pairs]), runs([y for _, y in pairs])
    n = [sum(x for x, _ in pairs), sum(y for _, y in pairs)]
    whole = [[1 + 10**9 * (pair[i] + 5) // (n[i] + 5 * len(pairs)) for pair in pairs] for i in (0, 1)]
    assert run_difference(a, pa, b, pb, len(pairs)) == sum(abs(x - y) for x, y in zip(*whole))


@settings(deadline=None)
@given(st.lists(st.integers(0, 1 << 50), min_size=1, max_size=20), st.integers(1, 1 << 30), st.integers(0, 1 << 52))
def test_probabilities_are_exact(column, v, more):
    total = sum(column) + more
    found = probabilities(np.array(column, np.int64), total, v)
    assert found.tolist() == [1 + 10**9 * (n + 5) // (total + 5 * v) for n in column]
