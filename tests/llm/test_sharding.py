from collections import Counter, defaultdict

import numpy as np
from edge import SCHEMA, clashing, with_edges

from msgflow.llm.queries import op3_histogram_shards
from msgflow.llm.sharding import places, shard_rows


def held(found, shards, tolerance, rows, whole_groups=True):
    """Checks the law of near equal bytes, the slots, and the groups; ``found`` has id, text, size, shard, slot."""
    assert Counter((r[0], r[1]) for r in found) == Counter(rows)
    sizes, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for _, text, size, shard, slot in found:
        assert size == len((text or "").encode()) + 16
        sizes[shard] += size
        slots[shard].append(slot)
        groups[text].add(shard)
    mean = sum(sizes.values()) / shards
    largest = max((r[2] for r in found), default=0)
    for shard in range(shards):
        assert abs(sizes[shard] - mean) <= tolerance * mean + 2 * largest
        assert sorted(slots[shard]) == list(range(len(slots[shard])))
    by_group = Counter()
    for r in found:
        by_group[r[1]] += r[2]
    if whole_groups:
        assert all(len(s) == 1 for g, s in groups.items() if by_group[g] <= tolerance * mean)
    return sizes


def test_all_rows(spark, sf_dir):
    docs = clashing(with_edges(spark, sf_dir), "size", "SHARD", "slot", "h", "d", "_piece")
    found = shard_rows(docs, 5, pieces=4)
    assert {"_piece", "h", "lang"} <= set(found.columns)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    held([tuple(r) for r in found.select("doc_id", "text", "size", "shard", "slot").collect()], 5, 0.05, rows)
    assert shard_rows(spark.createDataFrame([], SCHEMA), 5).collect() == []
    assert {r.shard for r in shard_rows(docs, 1).collect()} == {0}


def test_a_hot_group_is_split_by_id(spark):
    rows = [(i, "the same text in a third of all rows") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = [tuple(r) for r in shard_rows(docs, 10, pieces=3).select("doc_id", "text", "size", "shard", "slot").collect()]
    sizes = held(found, 10, 0.05, rows)
    assert max(sizes.values()) < 1.06 * min(sizes.values())
    assert len({r[3] for r in found if r[0] < 3000}) >= 5


def test_rows_that_can_not_be_parted(spark):
    docs = spark.createDataFrame([(1, "same")] * 500 + [(i, f"t{i}") for i in range(500)], "doc_id bigint, text string")
    found = shard_rows(docs, 4).collect()
    assert len({r.shard for r in found if r.text == "same"}) == 1
    assert len(found) == 1000


def test_places_with_ties():
    ph, pd = np.array([1, 5, 5, 5, 9]), np.array([0, -3, 2, 8, 0])
    h, d = np.array([0, 1, 5, 5, 5, 5, 10]), np.array([7, -1, -4, -3, 7, 9, 0])
    expected = [sum((a, b) <= (x, y) for a, b in zip(ph, pd)) for x, y in zip(h, d)]
    assert places(ph, pd, h, d).tolist() == expected


def test_query(spark, sf_dir):
    found = op3_histogram_shards(spark, sf_dir)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {r.law for r in found.collect()} == {"bytes"}
