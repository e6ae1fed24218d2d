"""Vector codes against a plain version in Python's integers."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from msgflow.llm.queries import QUERIES
from msgflow.llm.vectorcodes import ENTRIES, PARTS, vector_codes

from edge import rows_of


def plain_codes(rows, entries=ENTRIES, rounds=4):
    """(id, label, code, error, label_error, digest) of (id, vector, label) rows, vector by vector."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // PARTS)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(1024 * x) for x in v] + [0] * (width * PARTS - len(v)) for _, v, _ in kept]
    parts = [[v[p * width : (p + 1) * width] for v in whole] for p in range(PARTS)]
    books = [part[:entries] for part in parts]

    def nearest(part, book):
        return min((sum((x - c) ** 2 for x, c in zip(part, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(PARTS):
            members = {}
            for part in parts[p]:
                members.setdefault(nearest(part, books[p])[1], []).append(part)
            books[p] = [
                [sum(xs) // len(members[i]) for xs in zip(*members[i])] if i in members else entry for i, entry in enumerate(books[p])
            ]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    found = [[nearest(parts[p][r], books[p]) for p in range(PARTS)] for r in range(len(kept))]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = {}
    for (_, _, label), error in zip(kept, errors):
        of_label[label] = of_label.get(label, 0) + error
    return sorted(
        [(i, label, bytes(c for _, c in f).hex(), e, of_label[label], digest) for (i, _, label), f, e in zip(kept, found, errors)],
        key=repr,
    )


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def test_the_query_equals_the_plain_version(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in rows if r["vec_id"] < 300]
    assert rows_of(vector_codes(frame(spark, rows))) == plain_codes(rows)
    found = QUERIES["op11_vector_codes"](spark, sf_dir)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_unusable_vectors_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [(-1) ** k * k / 7, k % 3 - 1.5, 0.25, -k / 1000], k % 2) for k in range(40)]
    rows += [(k, [0.5] * 4, None) for k in range(40, 60)] + [(3, [0.5] * 4, 7), (3, [0.5] * 4, 7), (None, [1.0] * 4, 8)]
    rows += [(90, None, 1), (91, [1.0, None, 1.0, 1.0], 1), (92, [nan, 1.0, 1.0, 1.0], 1), (93, [1.0, -inf, 1.0, 1.0], None)]
    vectors = frame(spark, rows, "double").repartition(5)
    assert rows_of(vector_codes(vectors)) == plain_codes(rows)
    clashing = vectors.withColumns({name: F.lit("own") for name in ("code", "error", "id", "v", "n", "part")})
    assert rows_of(vector_codes(clashing)) == plain_codes(rows)


def test_unequal_lengths_and_many_equal_vectors(spark):
    rows = [(k, [k / 3, 1.0, -k / 5][: 1 + k % 3], 1) for k in range(30)] + [(k, [2.0, 2.0], 2) for k in range(30, 600)]
    assert rows_of(vector_codes(frame(spark, rows))) == plain_codes(rows)


def test_blocks_do_not_matter(spark, monkeypatch):
    from msgflow.llm import vectorcodes

    rows = [(k, [math.sin(k * j) for j in range(1, 9)], k % 5) for k in range(400)]
    expected = plain_codes(rows)
    for size in (1, 37):
        monkeypatch.setattr(vectorcodes, "BLOCK_VECTORS", size)
        assert rows_of(vector_codes(frame(spark, rows, "double").repartition(3))) == expected
    monkeypatch.setattr(vectorcodes, "BROADCAST_LABELS", 0)
    assert rows_of(vector_codes(frame(spark, rows, "double"))) == expected


def test_empty_tables_and_too_large_components(spark):
    assert vector_codes(frame(spark, [])).collect() == []
    assert vector_codes(frame(spark, [(1, None, 1)])).collect() == []
    assert [tuple(r)[:4] for r in vector_codes(frame(spark, [(1, [], 1), (2, [], None)])).orderBy("vec_id").collect()] == [
        (1, 1, "00000000", 0),
        (2, None, "00000000", 0),
    ]
    with pytest.raises(Exception, match="can not be coded"):
        vector_codes(frame(spark, [(1, [1e9], 1)])).collect()
