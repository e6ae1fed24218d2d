import numpy as np
import xxhash
from edge import SCHEMA, clashing, rows_of, with_edges

from msgflow.llm.queries import op10_simhash
from msgflow.llm.simhash import PIVOTS, fingerprint, forest, linked, simhash_groups


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split() if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, max_bits=4):
    """(id, fingerprint, least id of the component), comparing everything with everything."""
    prints = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    label = list(range(len(rows)))

    def root(a):
        while label[a] != a:
            a = label[a]
        return a

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= max_bits) + i + 1:
            label[root(i)] = root(int(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        least[r] = min([d for d in (least.get(r), doc) if d is not None], default=None)
    return [(d, int(prints[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


def test_matches_comparison_of_all_pairs(spark, sf_dir):
    docs = clashing(with_edges(spark, sf_dir), "simhash", "id", "k", "pivots", "component_id")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 100_000]
    docs = docs.where("length(coalesce(text, '')) < 100000")
    expected = sorted(((d, p, c) for d, p, c in plain_groups(rows)), key=repr)
    found = [(d, p % (1 << 64), c) for d, p, c in rows_of(simhash_groups(docs, tile_rows=3))]
    assert sorted(found, key=repr) == expected


def test_long_texts_and_repetition():
    text = b"a long text of many words " * 30_000
    assert fingerprint(text) == fingerprint(text.replace(b" ", b"\n\t"))
    assert fingerprint(b"Short Text") == xxhash.xxh64_intdigest(b"short text", 42)
    assert fingerprint(b"  \n") == 0


def test_chain_links_everything(spark):
    """Texts whose fingerprints lie at most four bits apart one by one form one component; the query's columns."""
    schema = "doc_id bigint, text string"
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_groups(empty).collect() == []
    base = "the quick brown fox jumps over the lazy dog and runs away from all the hounds of the old town today " * 5
    rows = [(i, base + " tail" * i) for i in range(40)]
    expected = sorted(plain_groups(rows))
    found = sorted((r[0], r[1] % (1 << 64), r[2]) for r in simhash_groups(spark.createDataFrame(rows, schema), tile_rows=4).collect())
    assert found == expected


def test_pivots_only_discard_what_is_too_far():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64))
    table = lambda v: np.bitwise_count(v[:, None] ^ PIVOTS).astype(np.int16)
    i, j = linked(x, table(x), y, table(y), 4)
    near = np.argwhere(np.bitwise_count(x[:, None] ^ y[None, :]) <= 4)
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(map(tuple, near.tolist()))
    assert len(forest(60, i, i)) == 0


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = sorted((d, f"{p:016x}", c) for d, p, c in plain_groups(rows))
    assert sorted(map(tuple, op10_simhash(spark, sf_dir).collect())) == expected
