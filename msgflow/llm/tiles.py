"""Rows of a key compared with each other in tiles, so that no task holds a large group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a tile; a key with more rows has several.
TILE_ROWS = 1000


def tiles(rows: DataFrame, counts: DataFrame, hashed: Column, payload: list[str], tile_rows: int = TILE_ROWS) -> DataFrame:
    """(k, one, two, rows): for each key all pairs of tiles of its rows; ``rows`` are structs of ``own`` and the payload.

    ``rows`` has the key ``k``, ``counts`` the keys with more than one row and their numbers of rows ``n_rows``, stored, so that
    Spark can split a large key in the join. Each row goes to as many tile pairs as its key has tiles, in which it is in
    the tile ``own``: ``one`` or ``two``, which are the same where a tile is compared with itself.
    """
    n = F.ceil(F.col("n_rows") / tile_rows).cast("int")
    own = F.pmod(hashed, n).cast("int")
    dealt = rows.join(counts, "k").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return (
        dealt.groupBy("k", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
        .agg(F.collect_list(F.struct("own", *payload)).alias("rows"))
        .where(F.size("rows") > 1)
    )
