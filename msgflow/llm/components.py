"""Connected components of a link table by alternating star contractions, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables


def _state(edges: DataFrame) -> tuple[int, int]:
    """Count and an order-free hash, which tell whether an iteration has changed anything."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def _stars(tables: Tables, edges: DataFrame, both_ways: bool) -> DataFrame:
    """Every node's neighbours are linked with the least of them (or the node itself).

    The minima are stored before the join: then both sides of the join come from plain exchanges, and Spark's
    skew handling can split the rows of a node with very many neighbours.
    """
    pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    least = tables.store(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    if both_ways:
        out = pairs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionByName(least.select("u", F.col("m").alias("v")))
    stored = tables.store(out.where("u > v").distinct())
    tables.drop(least)
    return stored


def components(tables: Tables, links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns ``a`` and ``b``, bigint): root is the component's least node.

    Links may repeat and come in any direction; a link of a node with itself is left out, and so are nulls. Each
    round takes two aggregations and two joins; the rounds grow with the logarithm of the longest path.
    """
    edges = tables.store(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:
        large = _stars(tables, edges, both_ways=True)
        small = _stars(tables, large, both_ways=False)
        tables.drop(edges, large)
        edges, before, state = small, state, _state(small)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return tables.store(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))
