"""How the sources of a language differ from each other, and what is typical of each: an audit of term probabilities over run-length columns.

The vocabulary of a language is put into an order in which equal counts lie together: by the terms' counts in its sources, the smallest source
first. Each (language, source) is then a column of runs of equal counts. Two sources are compared by intersecting the borders of
their runs: a stretch in which neither changes has one difference, which is multiplied by its length. The order is cut into blocks, and the
sources into tiles, so that a task compares two tiles of columns over one block. All arithmetic is in integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Tables

#: A term is kept in a language if this many of its documents hold it.
LEAST_DOCS = 30
#: Added to every count.
PRIOR = 5
#: Probabilities are this many parts of one.
PARTS = 1_000_000_000
TOP_TERMS = 50

#: Counts that a task adds up before it passes them on, which bounds its memory, and bytes of a text that it takes at a time.
TASK_COUNTS = 400_000
PIECE_BYTES = 1 << 20
#: Terms of a block and sources of a tile.
BLOCK_TERMS = 1 << 14
TILE_SOURCES = 64
#: The table of groups is broadcast up to this many (language, source) groups; beyond it Spark joins by group, and splits a hot one.
BROADCAST_GROUPS = 200_000

#: Letters A-Z and all code points from 128 on, whose UTF-8 bytes are all 128 or more; texts are lower-cased for A-Z before.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_NO_TERM = re.compile(rb"[^a-z\x80-\xff]")


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes that do not cut a term."""
    begin = 0
    while len(text) - begin > size:
        cut = _NO_TERM.search(text, begin + size)
        end = cut.start() if cut else len(text)
        yield text[begin:end]
        begin = end
    yield text[begin:]


def term_counts(docs: DataFrame, task_counts: int = TASK_COUNTS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, added up within a task; a key may come several times."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in counts.items():
                terms = list(n)
                columns = [
                    pa.array([lang], pa.string()).take(pa.array(np.zeros(len(terms), np.int32))),
                    pa.array([source], pa.string()).take(pa.array(np.zeros(len(terms), np.int32))),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(n.values(), pa.int64()),
                    pa.array([d[term] for term in terms], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, value in enumerate(batch.column(2)):
                text = (value.as_py() or b"").lower()  # of bytes, so A-Z only
                seen: set[bytes] | None = None
                for piece in _pieces(text, piece_bytes):
                    words = _TERM.findall(piece)
                    if not words:
                        continue
                    group = (langs[row], sources[row])
                    if group not in counts:
                        counts[group] = Counter(), Counter()
                    n, d = counts[group]
                    before = len(n)
                    n.update(words)
                    distinct = set(words)
                    if seen is not None:
                        distinct -= seen
                    d.update(distinct)
                    if len(text) > piece_bytes:
                        seen = distinct | (seen or set())
                    held += len(n) - before
                    if held >= task_counts:
                        yield from passed_on()
                        held = 0
        yield from passed_on()

    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(counted, "lang string, source string, term string, n long, docs long")


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, total, counts): the terms of enough documents of a language, with an array of (source, n).

    One shuffle by language and term serves both sums: a term has one row a task and source.
    """
    dealt = counts.repartition("lang", "term")
    by_source = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return by_term.where(F.col("docs") >= least_docs).drop("docs")


def _probability(n: str, total: str) -> Column:
    """1 + floor(PARTS * (n + PRIOR) / (total + PRIOR * V)), without overflow."""
    return F.expr(f"1 + (CAST({PARTS} AS DECIMAL(10, 0)) * ({n} + {PRIOR})) DIV ({total} + {PRIOR} * v)")


def probabilities(counts: np.ndarray, total: int, v: int) -> np.ndarray:
    """The same for an array of counts: long division in three digits of 1,000 each, so that nothing leaves 64 bits."""
    divisor = total + PRIOR * v
    if divisor >= 1 << 53:
        return np.array([1 + PARTS * (int(n) + PRIOR) // divisor for n in counts], np.int64)
    quotient, rest = np.divmod(counts + PRIOR, divisor)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, divisor)
        quotient = quotient * 1000 + digit
    return quotient + 1


def run_columns(terms: DataFrame, n_terms: int, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, block, size, source, starts, counts): of each block of the ordered vocabulary, the runs of equal counts of each source in it.

    ``terms`` has (lang, order, tie, counts), ``order`` being (place of the source, n) by source. A source that holds none of the
    block's terms has no row. A block lies within one task's range of the order, and in one language. There are about as many ranges as
    blocks, so the sample from which Spark finds their borders grows with the ``n_terms`` terms, not with the documents.
    """
    ranges = max(1, -(-n_terms // block_terms))
    ordered = terms.repartitionByRange(ranges, "lang", "order", "tie").sortWithinPartitions("lang", "order", "tie")
    ordered = ordered.select(F.spark_partition_id().alias("task"), "lang", "counts")
    names = ["lang", "block", "size", "source", "starts", "counts"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list[int], list[int]]] = {}  # of each source, places in the block and counts
        lang, size, number, task = None, 0, 0, 0

        def block() -> pa.RecordBatch:
            rows = []
            for source, (places, counts) in held.items():
                dense = np.zeros(size, np.int64)
                dense[places] = counts
                starts = np.flatnonzero(np.append(True, dense[1:] != dense[:-1]))
                rows.append((lang, f"{task}-{number}", size, source, starts.astype(np.int32), dense[starts]))
            types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if size and (row["lang"] != lang or size == block_terms):
                    yield block()
                    held, size, number = {}, 0, number + 1
                lang, task = row["lang"], row["task"]
                for entry in row["counts"]:
                    places, counts = held.setdefault(entry["source"], ([], []))
                    places.append(size)
                    counts.append(entry["n"])
                size += 1
        if size:
            yield block()

    return ordered.mapInArrow(
        runs, "lang string, block string, size int, source string, starts array<int>, counts array<bigint>"
    )


def run_difference(starts: np.ndarray, p: np.ndarray, other_starts: np.ndarray, other_p: np.ndarray, size: int) -> int:
    """The sum of absolute differences of two run-length columns: one difference a stretch between borders, times its length."""
    borders = np.union1d(starts, other_starts)
    lengths = np.diff(np.append(borders, size))
    here = p[np.searchsorted(starts, borders, "right") - 1]
    there = other_p[np.searchsorted(other_starts, borders, "right") - 1]
    return int((np.abs(here - there) * lengths).sum())


def _pair_sums(columns: DataFrame, tile_sources: int) -> DataFrame:
    """(lang, a, b, value): for every two sources of a language, a before b, the sum of differences over each block."""
    tiles = F.ceil(F.col("sources") / tile_sources).cast("int")
    own = F.floor(F.col("place") / tile_sources).cast("int")
    dealt = columns.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    groups = dealt.groupBy("lang", "block", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")).agg(
        F.collect_list(F.struct("own", "source", "total", "v", "size", "starts", "counts")).alias("columns")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index in range(batch.num_rows):
                group = batch.slice(index, 1).to_pylist()[0]
                found = []
                for c in group["columns"]:
                    if c["v"]:
                        starts, counts = np.array(c["starts"] or [0]), np.array(c["counts"] or [0], np.int64)
                        found.append((c["own"], c["source"], starts, probabilities(counts, c["total"], c["v"]), c["size"]))
                    else:
                        found.append((c["own"], c["source"], np.zeros(1, np.int64), np.zeros(1, np.int64), 0))
                one = [c for c in found if c[0] == group["one"]]
                two = one if group["one"] == group["two"] else [c for c in found if c[0] == group["two"]]
                sums = []
                for i, (_, a, starts, p, size) in enumerate(one):
                    for _, b, other_starts, other_p, _ in two[i + 1 :] if one is two else two:
                        value = run_difference(starts, p, other_starts, other_p, size)
                        sums.append((a, b, value) if a < b else (b, a, value))
                if sums:
                    a, b, values = zip(*sums)
                    langs = pa.array([group["lang"]] * len(a), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [langs, pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(values, pa.int64())],
                        names=["lang", "a", "b", "value"],
                    )

    return groups.mapInArrow(compared, "lang string, a string, b string, value long")


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    *,
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    block_terms: int = BLOCK_TERMS,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source lies from the others of its language, and its typical terms.

    Null texts, languages and sources count as ''. Terms are runs of letters A-Z, lower-cased, and of code points from 128 on; each language
    keeps those of at least ``least_docs`` documents. p = 1 + floor(PARTS * (count + PRIOR) / (N + PRIOR * V)) of a term, with N all occurrences
    of kept terms in the group and V the kept terms of the language. Part ``pair``: every other source of the language, with the sum of absolute differences
    of p over the kept terms, all ranks. Part ``term``: kept terms that the source holds and that are likelier in it than in the whole language, with the
    difference, up to ``top_terms`` ranks. Ranks go by value, descending, then by the item's bytes. Groups without a term
    take part with count 0; in a language without a kept term all pairs have 0. A language with one source has no pair.

    Rows count as often as they are repeated; their ids and other columns are not read. An empty table gives an empty result. A text
    is read in pieces, whatever its length; its distinct terms are held while it lasts.
    """
    tables = Tables(docs.sparkSession, "divergence")
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    terms = tables.store(kept_terms(term_counts(rows), least_docs))

    # A row for every (language, source): N, V, N of the language, number of sources, and the place of the source by size.
    counted = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source"))
    totals = counted.agg(F.sum("c.n").alias("total"))
    languages = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    groups = groups.fillna(0, ["total", "v", "lang_total"])
    by_size = Window.partitionBy("lang").orderBy("total", "source")
    groups = groups.withColumn("place", F.row_number().over(by_size) - 1)
    groups = tables.store(groups.withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang"))))
    named = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups

    flat = terms.select("lang", "term", F.col("total").alias("term_total"), F.inline("counts")).join(named, ["lang", "source"])
    flat = tables.store(flat.drop("sources").withColumn("p", _probability("n", "total")))

    entry = F.struct("place", "n")
    ordered = flat.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(entry)).alias("order"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    ordered = tables.store(ordered.select("lang", "order", F.xxhash64("term").alias("tie"), "counts"))
    n_terms = groups.where("place = 0").agg(F.sum("v")).first()[0] or 0
    columns = tables.store(run_columns(ordered, n_terms, block_terms))
    blocks = columns.select("lang", "block", "size").distinct()
    # Every source has a column in every block of its language; one without a row there is a single run of zeros.
    grid = groups.where(F.col("sources") > 1).join(blocks, "lang", "left")
    grid = grid.join(columns.drop("size"), ["lang", "block", "source"], "left")
    sums = _pair_sums(grid, tile_sources).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sums = tables.store(sums)
    tables.drop(ordered, columns)
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = sums.select("lang", both.alias("pair"), "value").select("lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value")

    likely = flat.withColumn("value", F.col("p") - _probability("term_total", "lang_total")).where("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    likely = likely.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)
    likely = likely.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return ranked.unionByName(likely)
