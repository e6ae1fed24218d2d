"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

Words are runs of letters, marks and digits in lower case; in scripts without spaces each character is one. The n-grams of an item, with n by the item's
length, are its seeds. A first scan of the documents counts them. Of each item the most frequent seeds are left out, as many as a copy can do
without. A second scan finds the places where as many of an item's other seeds come together as a copy keeps, and passages around them, wide enough
for the items of a length class, leave it. Passages meet items by a join on the seeds, by ids alone. Words are attached to the pairs, and every pair that a bound from the words in common does
not rule out is aligned. The local alignment of words bears replaced, added and left-out words.

A copy that reaches half of the best score has at most a third of its words replaced. So of the two-word seeds of a short item of L words L - 1 - 2 * (L // 3)
are intact at least (``intact_seeds``): what is beyond those asked for may be left out. Items of more than SHORT_ITEM words have
three-word seeds, of which two or three are asked for and a third may be left out; a copy is lost if its edits leave fewer whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Tables
from .text import BLOCK_BYTES, WORDS, column_bytes, first_of_docs, lowered, mixed, runs

#: Items of at most so many words have seeds of two words, longer ones of three.
SHORT_ITEM = 13
#: Seeds that tasks know exactly, with their items (some 24 MB); of a larger benchmark they know the bits only, and the join finds the rest.
MOST_KNOWN_SEEDS = 1_500_000
#: Seeds that occur at most so often in all documents are never left out.
RARE_SEED = 1000
#: Alignment: a match, a mismatch, a gap; and the share of the best possible score from which a pair counts.
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SHARE = 0.5
#: The table that a scan asks first has so many bits a seed, between these bounds (the upper one is 32 MB a length class).
FILTER_BITS_PER_SEED, LEAST_FILTER_BITS, MOST_FILTER_BITS = 64, 1 << 16, 1 << 28
#: Pairs compared at once, and words of their items, each taken as long as the longest.
_PAIRS, _ITEM_WORDS = 128, 1 << 17

#: What the fast path for words can not tell apart: characters that are neither ASCII nor letters of Latin-1.
_SIGN = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
_SINGLE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def plain_words(text: str) -> str:
    """The words of a text, in lower case and composed form, with white space between them."""
    text = unicodedata.normalize("NFC", text).lower()
    return _SINGLE.sub(r" \g<0> ", _SIGN.sub(" ", text))


def _unusual(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The texts with characters that are neither ASCII nor letters of Latin-1."""
    lead = data >= 0xC0
    odd = lead & (data != 0xC3)
    if len(data) > 1:
        odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    return np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)


def _word_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column, unusual texts replaced by their plain words."""
    offsets, data = column_bytes(column)
    unusual = _unusual(offsets - offsets[0], data[offsets[0] : offsets[-1]]) if len(offsets) > 1 else []
    if len(unusual):
        texts = column.cast(pa.large_string()).to_pylist()
        for i in unusual.tolist():
            texts[i] = plain_words(texts[i])
        return column_bytes(pa.array(texts, pa.large_string()))
    return offsets, data


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of n words."""
    m = max(0, len(words) - n + 1)
    out = np.full(m, n, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + m])
    return out


def _pieces(data: np.ndarray, begin: int, end: int, shared: int) -> Iterator[tuple[int, np.ndarray]]:
    """(position of the first word, hashes) of a document in pieces that begin with the last ``shared`` words of the piece before.

    A piece is read block by block until it has as many words of its own, however few of them a block holds.
    """
    parts: list[np.ndarray] = []
    position = own = 0
    while begin < end:
        stop = min(end, begin + BLOCK_BYTES)
        if stop < end and len(breaks := np.flatnonzero(WORDS[data[begin:stop]] == 0)):
            stop = begin + int(breaks[-1]) + 1
        parts.append(runs(lowered(data[begin:stop]), np.array([0, stop - begin]), WORDS).hashes)
        own += len(parts[-1])
        begin = stop
        if own and (own >= shared or begin == end):
            hashes = np.concatenate(parts)
            yield position, hashes
            kept = min(shared, len(hashes))
            position += len(hashes) - kept
            parts, own = [hashes[len(hashes) - kept :]], 0


def _documents(column: pa.Array, shared: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, position in it, hash) of the words of a column, in blocks whose documents ascend.

    A document longer than a block comes in pieces that share ``shared`` words.
    """
    offsets, data = _word_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1)
        begin, end = int(offsets[first]), int(offsets[last])
        if end - begin > BLOCK_BYTES:
            for position, hashes in _pieces(data, begin, end, shared):
                yield np.full(len(hashes), first), position + np.arange(len(hashes)), hashes
        elif end > begin:
            r = runs(lowered(data[begin:end]), offsets[first : last + 1] - begin, WORDS)
            new = first_of_docs(r.docs)
            lengths = np.diff(np.append(new, len(r.docs)))
            if len(r.docs):
                yield first + r.docs, np.arange(len(r.docs)) - np.repeat(new, lengths), r.hashes
        first = last


def item_words(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """(item, item_id, words) of items with at least one word; ``item`` tells them apart by id, which can be null, and words."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, words = batch.column("text"), []
            for i in range(len(texts)):
                parts = [h for _, _, h in _documents(texts.slice(i, 1), 0)]
                words.append(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(words, pa.list_(pa.int64()))], ["item_id", "words"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(compute, f"item_id {kind}, words array<bigint>").where("size(words) > 0").distinct()
    return found.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words")


def seed_width(words: int) -> int:
    """The words of a seed of an item of so many words."""
    return min(words, 2 if words <= SHORT_ITEM else 3)


def intact_seeds(words: int) -> int:
    """How many two-word seeds a copy keeps at least that has a third of its words replaced."""
    return words - 1 - 2 * (words // 3)


def seeds_asked(words: int) -> int:
    """How many kept seeds a passage shares with an item before the two are compared."""
    if seed_width(words) == 3:
        return 2 if words < 20 else 3
    return max(1, min(intact_seeds(words), 2 if words < 10 else 3))


def seeds_left_out(words: int) -> int:
    """How many of its most frequent seeds an item can do without."""
    if seed_width(words) == 3:
        return (words - 2) // 3
    return max(0, intact_seeds(words) - seeds_asked(words)) if words > 2 else 0


def item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item, width, class, asked, left_out) of all seeds of items; the class is the item's length rounded up to a power of two."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = [len(v) for v in batch.column("words")]
            seeds = [_grams(np.asarray(v.values).view(np.uint64), seed_width(n)) for v, n in zip(batch.column("words"), lengths)]
            at = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
            by_item = [
                [seed_width(n) for n in lengths],
                [max(4, (n - 1).bit_length()) for n in lengths],
                [seeds_asked(n) for n in lengths],
                [seeds_left_out(n) for n in lengths],
            ]
            columns = [pa.array(np.concatenate(seeds).view(np.int64)), batch.column("item").take(pa.array(at))]
            columns += [pa.array(np.array(values)[at], pa.int32()) for values in by_item]
            yield pa.RecordBatch.from_arrays(columns, names=["seed", "item", "width", "class", "asked", "left_out"])

    fields = "seed bigint, item bigint, width int, class int, asked int, left_out int"
    return items.select("item", "words").mapInArrow(compute, fields).distinct()


def rare_seeds(seeds: DataFrame, counts: DataFrame) -> DataFrame:
    """The seeds without the most frequent ones of each item. A seed that occurs RARE_SEED times or less stays in any case."""
    known = seeds.join(counts, "seed", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("n"), "seed"))
    return known.withColumn("rank", rank).where((F.col("rank") > F.col("left_out")) | (F.col("n") <= RARE_SEED)).drop("rank", "n")


class _Known:
    """The seeds of a class in ascending order, the items of each, and how many seeds each item asks for."""

    def __init__(self, seed: np.ndarray, item: np.ndarray, asked: np.ndarray) -> None:
        order = np.argsort(seed, kind="stable")
        _, number = np.unique(item, return_inverse=True)
        self.seeds, first = np.unique(seed[order], return_index=True)
        self.starts = np.append(first, len(seed))
        self.items = number[order].astype(np.int32)
        self.asked = np.zeros(len(np.unique(item)), np.int32)
        self.asked[number] = asked

    def together(self, doc: np.ndarray, at: np.ndarray, grams: np.ndarray, reach: int) -> np.ndarray:
        """Of the places ``at`` those where seeds of one item lie so close together, as many as it asks for."""
        found = np.minimum(np.searchsorted(self.seeds, grams), len(self.seeds) - 1)
        exact = self.seeds[found] == grams
        at, found = at[exact], found[exact]
        n = self.starts[found + 1] - self.starts[found]
        ends = np.cumsum(n)
        if not len(ends):
            return at
        item = self.items[np.repeat(self.starts[found] - ends + n, n) + np.arange(ends[-1])]
        place = np.repeat(at, n)
        order = np.lexsort((place, item, doc[place]))
        place, item = place[order], item[order]
        d, marks = doc[place], np.zeros(len(place) + 1, np.int64)
        for k in np.unique(self.asked).tolist():
            i = np.flatnonzero(self.asked[item] == k)
            i = i[i + k <= len(place)]
            j = i + k - 1
            near = (item[i] == item[j]) & (d[i] == d[j]) & (place[j] - place[i] <= reach)
            np.add.at(marks, i[near], 1)
            np.add.at(marks, j[near] + 1, -1)
        return np.unique(place[np.cumsum(marks)[:-1] > 0])


class _Filter:
    """The seeds of one class: a bit for each hash value modulo the size of the table, the widths of the seeds, and the seeds where they are few."""

    def __init__(self, table: np.ndarray, widths: list[int], longest: int, known: _Known | None) -> None:
        self.table, self.widths, self.longest, self.known = table, widths, longest, known

    def hits(self, grams: np.ndarray) -> np.ndarray:
        bit = grams % np.uint64(8 * len(self.table))
        return (self.table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _filters(seeds: DataFrame, most_known: int = 0) -> dict[int, _Filter]:
    """The filter of each class of items, of which there are as many as powers of two up to the longest item."""
    out = {}
    classes = seeds.groupBy("class").agg(
        F.count_distinct("seed").alias("n"), F.collect_set("width").alias("widths"), F.count("*").alias("rows")
    ).collect()
    few = sum(row["rows"] for row in classes) <= most_known
    for row in classes:
        bits = min(MOST_FILTER_BITS, max(LEAST_FILTER_BITS, 1 << (FILTER_BITS_PER_SEED * row["n"] - 1).bit_length()))
        bit = F.pmod(F.col("seed"), F.lit(bits))
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))
        mine = seeds.where(F.col("class") == row["class"])
        table = np.zeros(bits // 64, np.int64)
        for at, value in mine.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one)).collect():
            table[at] = value
        known = None
        if few:
            columns = mine.select("seed", "item", "asked").toArrow()
            seed, item, asked = (columns[c].to_numpy() for c in ("seed", "item", "asked"))
            known = _Known(seed.view(np.uint64), item, asked)
        out[row["class"]] = _Filter(table.view(np.uint8), sorted(row["widths"]), 1 << row["class"], known)
    return out


def _hits(filters: dict[int, _Filter], doc: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each class the grams of its widths, and which of them lie in one document and may be seeds."""
    grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for number, filter_ in filters.items():
        found = []
        for n in filter_.widths:
            if n not in grams:
                g = _grams(words, n)
                grams[n] = g, doc[: len(g)] == doc[n - 1 :] if n > 1 else np.ones(len(g), bool)
            g, inside = grams[n]
            found.append((g, inside & filter_.hits(g)))
        yield number, found


def seed_counts(docs: DataFrame, text: str, filters: dict[int, _Filter]) -> DataFrame:
    """(seed, n): how often each possible seed occurs in all documents; every task adds up its own."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, _, words in _documents(batch.column("text"), 0):
                found += [g[ok] for _, hits in _hits(filters, doc, words) for g, ok in hits if ok.any()]
            if found:
                seeds, counts = np.unique(np.concatenate(found), return_counts=True)
                columns = [pa.array(seeds.view(np.int64)), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["seed", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(scan, "seed bigint, n bigint")
    return counted.groupBy("seed").agg(F.sum("n").alias("n"))


def passages(docs: DataFrame, id_col: str, text: str, filters: dict[int, _Filter]) -> DataFrame:
    """(id, class, at, seeds, words): places of documents with possible seeds of a class, and the words around them.

    Where the seeds are known, places count at which an item's seeds come together as it asks for, else all. Hits within four item lengths of the first one share a passage, which reaches one and a half item lengths further on either
    side; so every alignment around a hit lies in a passage, and the size of a passage has a bound. The length is the longest of the class.
    """
    fields = "class int, at bigint, seeds array<bigint>, words array<bigint>"
    kind = docs.schema[id_col].dataType.simpleString()
    longest = max((f.longest for f in filters.values()), default=1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: tuple[list, ...] = [], [], [], [], []
            for doc, position, words in _documents(batch.column("text"), 7 * longest):
                for number, grams in _hits(filters, doc, words):
                    length = filters[number].longest
                    margin, reach = length + length // 2, 4 * length
                    hit = np.zeros(len(words), bool)
                    for g, ok in grams:
                        hit[: len(g)] |= ok
                    hits = np.flatnonzero(hit)
                    if len(hits) and (known := filters[number].known):
                        places = [np.flatnonzero(ok) for _, ok in grams]
                        values = [g[at] for (g, _), at in zip(grams, places)]
                        hits = known.together(doc, np.concatenate(places), np.concatenate(values), reach)
                    while len(hits):
                        d = doc[hits[0]]
                        inside = int(np.searchsorted(hits, min(hits[0] + reach, np.searchsorted(doc, d, "right")), "left"))
                        mine, hits = hits[:inside], hits[inside:]
                        lo = max(int(mine[0]) - margin, int(np.searchsorted(doc, d, "left")))
                        hi = min(int(mine[-1]) + margin, int(np.searchsorted(doc, d, "right")))
                        seeds = np.unique(np.concatenate([g[mine[mine < len(g)]][ok[mine[mine < len(g)]]] for g, ok in grams]))
                        values = int(d), number, int(position[lo]), seeds.view(np.int64), words[lo:hi].view(np.int64)
                        for held, value in zip(found, values):
                            held.append(value)
            if found[0]:
                columns = [batch.column("id").take(pa.array(found[0])), pa.array(found[1], pa.int32()), pa.array(found[2], pa.int64())]
                columns += [pa.array(v, pa.list_(pa.int64())) for v in found[3:]]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "class", "at", "seeds", "words"])

    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(scan, f"id {kind}, {fields}")


def _best_run(lists: list[np.ndarray], common: np.ndarray) -> np.ndarray:
    """For each list, the best sum over a run of its words: MATCH for a word that is ``common``, the least loss for another."""
    sizes = np.array([len(x) for x in lists])
    within = np.arange(sizes.max(initial=0)) < sizes[:, None]
    sums = np.zeros((len(lists), within.shape[1] + 1), np.int32)
    steps = np.full(within.shape, max(MISMATCH, GAP), np.int32)
    steps[within] = np.where(common, MATCH, max(MISMATCH, GAP))
    np.cumsum(steps, axis=1, out=sums[:, 1:])
    return (sums - np.minimum.accumulate(sums, axis=1)).max(axis=1)


def most_score(passages_: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """A bound that the alignment scores of pairs of word sequences never exceed.

    A word inside an alignment either meets its like, which the other side must hold, or costs a mismatch or a gap.
    """
    keys = []
    for lists in (passages_, items):
        pair = np.repeat(np.arange(len(lists), dtype=np.uint64), [len(x) for x in lists])
        keys.append(mixed(np.concatenate(lists).view(np.uint64) + pair * np.uint64(0x9E3779B97F4A7C15)))
    p, q = keys
    return np.minimum(_best_run(passages_, np.isin(p, q)), _best_run(items, np.isin(q, p)))


def _together(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """``order`` in parts of pairs whose items are of like size, so that a long item does not stretch the short ones."""
    magnitude = np.frexp(sizes[order])[1]
    for m in np.unique(magnitude).tolist():
        mine = order[magnitude == m]
        n = max(1, min(_PAIRS, _ITEM_WORDS >> m))
        yield from (mine[at : at + n] for at in range(0, len(mine), n))


def align(passages_: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """The best local alignment scores of pairs of word sequences, all pairs at once, row by row of the table.

    Within a row the gaps in the passage are a running maximum of the scores, each raised by its place.
    """
    n, rows, columns = len(items), max(map(len, passages_), default=0), max(map(len, items), default=0)
    p, q = np.zeros((n, rows), np.int64), np.zeros((n, columns), np.int64)
    for k, (a, b) in enumerate(zip(passages_, items, strict=True)):
        p[k, : len(a)], q[k, : len(b)] = a, b
    in_p = np.arange(rows) < np.array([len(a) for a in passages_])[:, None]
    in_q = np.arange(columns) < np.array([len(b) for b in items])[:, None]
    score = np.zeros((n, columns + 1), np.int32)
    best = np.zeros(n, np.int32)
    place = -GAP * np.arange(columns + 1, dtype=np.int32)
    for i in range(rows):
        same = (p[:, i, None] == q) & in_q & in_p[:, i, None]
        row = np.zeros_like(score)
        np.maximum(score[:, :-1] + np.where(same, MATCH, MISMATCH), score[:, 1:] + GAP, out=row[:, 1:], casting="unsafe")
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + place, axis=1) - place
        np.maximum(best, row.max(axis=1), out=best)
        score = row
    return best


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id_col: str = "item_id",
    item_text: str = "text",
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(id_col, item_id_col, score, share, shared_seeds) of documents that hold an item, whole, edited or in large part.

    ``score`` is the best local alignment's, ``share`` that of the score of the whole item unchanged; pairs from ``least_share`` on
    are returned, once per document id and item. An item of one word has it as its seed; items
    without words match nothing, nor do null or empty texts. Null ids of documents and of items are kept as null. Rows that
    repeat give one row; an item id with several texts is found by any of them, and has the scores of the best. Empty tables give an empty result. Other columns are not read.
    Documents and items may have any length: long ones are read in pieces that share more words than an alignment spans.
    ``shared_seeds`` counts the kept seeds that passage and item share.
    """
    tables = Tables(docs.sparkSession, "leaks")
    words = tables.store(item_words(items, item_id_col, item_text))
    seeds = tables.store(item_seeds(words))
    counts = tables.store(seed_counts(docs, text, _filters(seeds)))
    rare = tables.store(rare_seeds(seeds, counts))
    found = tables.store(passages(docs, id_col, text, _filters(rare, MOST_KNOWN_SEEDS)))
    passage: Column = F.xxhash64("id", "class", "at", "words").alias("passage")
    hits = tables.store(found.select(passage, "class", F.explode("seeds").alias("seed")).distinct())
    shared = hits.join(rare.select("seed", "item", "class", "asked"), ["seed", "class"]).groupBy("passage", "item", "asked")
    pairs = tables.store(shared.agg(F.count("*").alias("seeds")).where(F.col("seeds") >= F.col("asked")).drop("asked"))
    candidates = (
        found.select("id", "at", passage, "words")
        .join(pairs, "passage")
        .join(words.select("item", "item_id", F.col("words").alias("item_words")), "item")
        .select("id", "item_id", "seeds", "words", "item_words")
    )
    kinds = {c: candidates.schema[c].dataType.simpleString() for c in ("id", "item_id")}

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.asarray(v.values) for v in batch.column(c)] for c in ("words", "item_words"))
            sizes = np.array([len(b) for b in right], np.float64)
            whole = MATCH * sizes
            order = np.argsort([len(a) for a in left], kind="stable")
            score = np.zeros(len(order), np.int64)
            for some in _together(order, sizes):
                score[some] = most_score([left[k] for k in some], [right[k] for k in some])
            order = order[(score / whole >= least_share)[order]]
            for some in _together(order, sizes):
                score[some] = align([left[k] for k in some], [right[k] for k in some])
            kept = pa.array(np.sort(order))
            columns = [batch.column("id"), batch.column("item_id"), pa.array(score), pa.array(score / whole), batch.column("seeds")]
            yield pa.RecordBatch.from_arrays([c.take(kept) for c in columns], names=["id", "item_id", "score", "share", "seeds"])

    scored = candidates.mapInArrow(
        aligned, f"id {kinds['id']}, item_id {kinds['item_id']}, score bigint, share double, seeds bigint"
    )
    best = scored.where(F.col("share") >= least_share).groupBy(F.col("id").alias(id_col), F.col("item_id").alias(item_id_col))
    best = best.agg(F.max("score").alias("score"), F.max("share").alias("share"), F.max("seeds").alias("shared_seeds"))
    best = tables.store(best)
    tables.drop(words, seeds, counts, rare, found, hits, pairs)
    return best
