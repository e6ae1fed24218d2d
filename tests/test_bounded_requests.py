"""Requests bounded by items and bytes against a plain next-fit packing."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from msgflow.operators import bounded_request_batches, bounded_requests, item_json_bytes, request_bodies, room_for_items
from msgflow.operators.bounded_requests import _fold, _table, joined, next_starts
from pyspark.sql import functions as F


def plain_requests(sizes, max_items, max_bytes):
    """The request number of each item, one after the other."""
    out, number, items, total = [], -1, 0, 0
    for size in sizes:
        if not items or items == max_items or total + size > max_bytes:
            number, items, total = number + 1, 0, 0
        items, total = items + 1, total + size
        out.append(number)
    return out


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60), st.integers(1, 6), st.integers(0, 20), st.lists(st.integers(1, 9)))
def test_ranges_fold_to_the_plain_packing(sizes, max_items, max_bytes, cuts):
    parts, rest = [], sizes
    for cut in cuts:
        if rest[cut:]:
            parts, rest = [*parts, rest[:cut]], rest[cut:]
    parts = [np.array(part, np.int64) for part in (*parts, rest)]
    states = _fold([_table(part, max_items, max_bytes) for part in parts], max_items, max_bytes)
    found, number = [], -1
    for part, state in zip(parts, states, strict=True):
        at = joined(np.append(0, np.cumsum(part[:max_items])), *state, max_items, max_bytes)
        following, begins = next_starts(part, max_items, max_bytes), set()
        while at < len(part):
            begins.add(at)
            at = int(following[at])
        for i in range(len(part)):
            number += i in begins
            found.append(number)
    assert found == plain_requests(sizes, max_items, max_bytes)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "owner string, number long, text string")


def packed(df, **bounds):
    out = bounded_request_batches(df, group="owner", order="number", content=F.col("text"), **bounds)
    return {(r["owner"], r["request_no"]): ([tuple(i) for i in r["items"]], r["items_bytes"]) for r in out.collect()}


def expected(rows, max_items, max_bytes):
    out = {}
    for owner in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == owner), key=lambda r: (r[0], len((r[1] or "").encode())))
        sizes = [len((text or "").encode()) for _, text in mine]
        for (number, text), size, request in zip(mine, sizes, plain_requests(sizes, max_items, max_bytes), strict=True):
            items, total = out.get((owner, request), ([], 0))
            out[owner, request] = [*items, (number, text)], total + size
    return out


@pytest.mark.parametrize("bits", [1, 4, 18])
@pytest.mark.parametrize("max_items, max_bytes", [(1, 1000), (3, 40), (1000, 25), (7, 10**9), (5, 0)])
def test_groups_of_all_kinds(spark, monkeypatch, bits, max_items, max_bytes):
    monkeypatch.setattr(bounded_requests, "RANGE_BITS", bits)
    rows = [("hot", k, "x" * (k * 7 % 23)) for k in range(300)]
    rows += [("few", 1, "é" * 30), ("few", 2, None), ("few", 3, ""), (None, 5, "no owner"), (None, -5, "y" * 50)]
    found = packed(rows_of(spark, rows).repartition(5), max_items=max_items, max_bytes=max_bytes)
    assert found == expected(rows, max_items, max_bytes)


def test_equal_orders_and_repeated_rows(spark):
    rows = [("a", 1, "same")] * 5 + [("a", 1, "b"), ("a", 2, "same"), ("a", 2, "same"), ("a", 1, "longer text")]
    found = packed(rows_of(spark, rows), max_items=4, max_bytes=20)
    assert {k: (items, size) for k, (items, size) in found.items()} == expected(rows, 4, 20)


def test_empty_tables_and_wrong_bounds(spark):
    empty = rows_of(spark, [])
    assert packed(empty, max_items=3, max_bytes=10) == {}
    with pytest.raises(ValueError, match="integer column"):
        bounded_request_batches(empty, group="owner", order="text", max_items=1, max_bytes=1, content=F.col("text"))
    with pytest.raises(ValueError, match="one item at least"):
        bounded_request_batches(empty, group="owner", order="number", max_items=0, max_bytes=1, content=F.col("text"))


def test_bodies_keep_to_their_bound(spark):
    rows = [("a", k, 'quote " and \\ and é' * (k % 9)) for k in range(200)] + [("a", 500, "z" * 5000)]
    request = {"system": "s", "prompt": 'p "é"', "domain": "d", "model": "m"}
    room = room_for_items(spark, 2000, **request)
    batches = bounded_request_batches(
        rows_of(spark, rows),
        group="owner",
        order="number",
        max_items=50,
        max_bytes=room,
        content=F.col("text"),
        item_bytes=item_json_bytes(F.col("text")),
    )
    bodies = request_bodies(batches, **request).collect()
    assert all(r["body_bytes"] == 2000 - room + r["items_bytes"] for r in bodies)
    assert [len(r["items"]) for r in bodies if r["body_bytes"] > 2000] == [1]
    assert sum(len(r["items"]) for r in bodies) == 201
