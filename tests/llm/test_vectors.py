import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from msgflow.llm.queries import op6_near_vectors
from msgflow.llm import vectors
from msgflow.llm.vectors import _rows_at_once, deviations_for, first_common, near_vectors, passed_filters, unit, words_for

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, k string"


def plain(rows, cosine=0.93):
    """(id, links, component, kept) by comparing everything with everything."""

    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [usable(v, label) for _, v, label in rows]
    near = [[] for _ in rows]
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            w, other = rows[j][1], rows[j][2]
            if ok[i] and ok[j] and label == other and len(v) == len(w):
                a, b = (np.asarray(x, np.float32).astype(float) for x in (v, w))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                    near[i].append(j)
                    near[j].append(i)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None) if ok[i] else vec
        out.append((vec, len(near[i]), least, vec is not None and vec == least))
    return sorted(out, key=repr)


def sample_rows():
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for label in (0, 1, 2):
        for _ in range(30):
            base = rng.normal(size=16)
            for _ in range(rng.integers(1, 5)):
                rows.append((i, (base + rng.normal(size=16) * 0.12).tolist(), label))
                i += 1
    hot = rng.normal(size=16).tolist()
    rows += [(1000 + k, hot, 1) for k in range(40)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [None] * 16, 1), (2004, [float("nan")] * 16, 1)]
    rows += [(2005, [float("inf")] * 16, 1), (2006, hot, None), (None, hot, 1), (2007, hot, 2), (2007, hot, 2), (2008, hot[:8], 1)]
    rows += [(2009, [-0.0, *hot[1:]], 0), (2010, [0.0, *hot[1:]], 0), (2011, [1e30 * x for x in hot], 0)]
    return rows


def test_matches_comparison_of_all_pairs(spark):
    rows = sample_rows()
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)
    found = near_vectors(df, deviations=2.0, tile_rows=7)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)
    doubles = df.withColumn("embedding", df["embedding"].cast("array<double>"))
    assert sorted(map(tuple, near_vectors(doubles, deviations=2.0).collect()), key=repr) == plain(rows)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_production_default_in_few_dimensions(spark):
    """Against the comparison of all pairs, dimension by dimension: nothing else links, and hardly a link is missed."""
    rng = np.random.default_rng(12)
    dimensions, rows = (1, 2, 4, 8, 16, 24), []
    for d in dimensions:
        for _ in range(30):
            base = unit(rng.normal(size=(1, d)))
            for _ in range(4):
                rows.append((len(rows), (base + rng.normal(size=(1, d)) * 0.22 / d**0.5)[0].tolist(), 1))
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)
    found = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
    expected = {vec: n for vec, n, _, _ in plain(rows)}
    for d in dimensions:
        ids = [i for i, v, _ in rows if len(v) == d]
        assert all(found[i] <= expected[i] for i in ids)
        assert sum(found[i] for i in ids) >= 0.96 * sum(expected[i] for i in ids) > 0


def test_recall_at_the_least_cosine_in_other_dimensions():
    rng = np.random.default_rng(13)
    for d, cosine in ((6, 0.93), (8, 0.93), (12, 0.93), (16, 0.93), (24, 0.93), (32, 0.93), (100, 0.93), (32, 0.98)):
        a, other = unit(rng.normal(size=(2000, d))), rng.normal(size=(2000, d))
        other = unit(other - (other * a).sum(1, keepdims=True) * a)
        b = cosine * a + math.sqrt(1 - cosine**2) * other
        pairs = [[set() for _ in a] for _ in range(2)]
        for sets, x in zip(pairs, (a, b)):
            for r, f in zip(*(v.tolist() for v in passed_filters(x, deviations_for(d, cosine)))):
                sets[r].add(f)
        recall = np.mean([bool(p & q) for p, q in zip(*pairs)])
        print(f"{d} dimensions, recall at {cosine}: {recall}, filters a vector: {np.mean([len(p) for p in pairs[0]])}")
        assert recall >= 0.97
    assert deviations_for(2, 0.93) == deviations_for(4, 0.93) == -math.inf
    assert deviations_for(64, 0.93) == 3.1


def test_list_decoding_finds_exactly_the_filters_that_exceed():
    rng = np.random.default_rng(8)
    from msgflow.llm.vectors import BLOCKS, CODES, DEVIATIONS, WORDS, _codes

    x, expected = unit(rng.normal(size=(20, 32))), set()
    for code in range(CODES):
        rotation, codes = _codes(32, code)
        parts = np.split(x @ rotation, BLOCKS, axis=1)
        for f in range(WORDS**BLOCKS):
            words = [f // WORDS ** (BLOCKS - 1 - b) % WORDS for b in range(BLOCKS)]
            total = sum(p @ c[:, w] for p, c, w in zip(parts, codes, words))
            expected |= {(int(i), code * WORDS**BLOCKS + f) for i in np.flatnonzero(total >= DEVIATIONS / 32**0.5)}
    assert set(zip(*(v.tolist() for v in passed_filters(x)))) == expected


def test_recall_at_the_least_cosine():
    """Pairs at a cosine of exactly 0.93 share a filter almost always with the registered parameters."""
    rng = np.random.default_rng(11)
    a = unit(rng.normal(size=(3000, 64)))
    other = rng.normal(size=a.shape)
    other = unit(other - (other * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * other
    left, right = [set() for _ in a], [set() for _ in a]
    for sets, x in ((left, a), (right, b)):
        for r, f in zip(*passed_filters(x)):
            sets[r].add(int(f))
    recall = np.mean([bool(p & q) for p, q in zip(left, right)])
    print("recall at 0.93:", recall)
    assert recall >= 0.97


def test_filters_grow_with_the_vectors(spark):
    """The unlike vectors of a label that a vector is compared with stay about as many from 10,000 to 2 million, and the recall stays."""
    rng = np.random.default_rng(14)
    a = unit(rng.normal(size=(1200, 64)))
    other = rng.normal(size=a.shape)
    other = unit(other - (other * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * other
    sizes = [10_000, 50_000, 200_000, 2_000_000]
    levels = [r.w for r in spark.createDataFrame([(n,) for n in sizes], "n long").select("n", words_for(F.col("n")).alias("w")).orderBy("n").collect()]
    assert levels == [64, 128, 256, 512] and all(8 * w * w >= n for w, n in zip(levels, sizes))
    compared = []
    for n, n_words in zip(sizes, levels):
        threshold, rows = deviations_for(64, 0.93, n_words), _rows_at_once(n_words)
        left, right = [], []
        for sets, x in ((left, a), (right, b)):
            for at in range(0, len(x), rows):
                part = x[at : at + rows]
                row, filter_ = passed_filters(part, threshold, n_words)
                sets += [set(p.tolist()) for p in np.split(filter_, np.searchsorted(row, np.arange(1, len(part))))]
        together = Counter(f for sets in left for f in sets)
        compared.append(n * sum(c * (c - 1) for c in together.values()) / len(a) / (len(a) - 1))
        recall = np.mean([bool(p & q) for p, q in zip(left, right)])
        print(f"{n} vectors, {n_words} words: {compared[-1]:.0f} comparisons a vector, recall {recall:.3f}")
        assert recall >= 0.97
    assert max(compared[:3]) <= 2 * min(compared[:3]) and compared[3] <= 8 * compared[0]


def test_labels_of_all_sizes(spark, monkeypatch):
    """With many filters a vector, labels have code words of their own number; nothing is lost against the comparison of all pairs."""
    rng = np.random.default_rng(15)
    rows = []
    for label, n in ((0, 3), (1, 60), (2, 200)):
        for _ in range(n):
            base = rng.normal(size=32)
            rows += [(len(rows) + k, (base + rng.normal(size=32) * 0.05).tolist(), label) for k in range(2)]
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)
    for limit in (200_000, 0):
        monkeypatch.setattr(vectors, "FILTERS_PER_VECTOR", 500)
        monkeypatch.setattr(vectors, "BROADCAST_LABELS", limit)
        assert sorted(map(tuple, near_vectors(df).collect()), key=repr) == plain(rows)


def test_first_common():
    a, b = np.array([[1, 4, 9], [2, 3, -1]], np.int32), np.array([[4, 9, -2], [5, 6, 7]], np.int32)
    assert first_common(a, b).tolist() == [4, np.iinfo(np.int32).max]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, op6_near_vectors(spark, sf_dir).collect()), key=repr) == plain(rows)
