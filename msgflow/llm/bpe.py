"""Byte-level BPE by merge replay over a vocabulary of words, and decoding.

Merges never cross the borders of the words that the splitting pattern matches. So a block of texts is a set of distinct words:
an inverted index from each pair of neighbouring tokens to its positions in those words is built once for the block, and the
merges are applied in rank order, each to all its positions at once; only the pairs of the touched neighbours are added to
the index. A task replays the merges block by block (BLOCK_BYTES), each time for the words that it does not keep from earlier
blocks (KEPT_BYTES), and documents are put together from their words' tokens. (The words of the whole corpus in one shared table would have to meet the documents in a
shuffle of all texts; what a word becomes does not depend on the other words, so the result is the same.)
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .tables import add_columns
from .text import column_bytes

#: Bytes of words and their tokens that a task keeps before it starts afresh, and bytes of text replayed at once.
KEPT_BYTES = 32 << 20
BLOCK_BYTES = 2 << 20
#: What a kept word takes besides its characters and tokens: its place in the dictionary, its number and its offset.
_WORD_BYTES = 120


class Ranks:
    """A rank file: token bytes by id, and for every pair of tokens whose joined bytes are a token that token's id."""

    def __init__(self, content: bytes) -> None:
        lines = [line.split() for line in content.splitlines() if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in lines}
        tokens = [b""] * (max(self.ids.values(), default=-1) + 1)
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.of_byte = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.append(0, np.cumsum(self.lengths))
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.pairs = {
            self.ids[token[:cut]] << 32 | self.ids[token[cut:]]: rank
            for token, rank in self.ids.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ids and token[cut:] in self.ids
        }


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words, one after the other, and the offsets of each word's tokens.

    All words lie in one array of token ids with links to the previous and next position; ``index`` has the positions
    of each pair that has a rank. Ranks come from a heap in ascending order; what a merge makes has, in a trained
    vocabulary, a higher rank than the merge itself.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    bounds = np.append(0, np.cumsum(lengths))
    token = ranks.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    whole = np.array([ranks.ids.get(w, -1) for w in words], np.int64)
    following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    begins, lasts = bounds[:-1][lengths > 0], bounds[1:][lengths > 0] - 1
    before[begins], following[lasts] = -1, n
    alive = np.ones(n, bool)
    # A word that is a token itself needs no merges.
    for w in np.flatnonzero((whole >= 0) & (lengths > 1)):
        a, b = bounds[w], bounds[w + 1]
        token[a], following[a], alive[a + 1 : b] = whole[w], n, False
        before[a + 1 : b], following[a + 1 : b] = -1, n
    index: dict[int, list[tuple[int, np.ndarray]]] = {}
    heap: list[int] = []

    def add(at: np.ndarray) -> None:
        """Puts the pairs that begin at these positions into the index, by the rank of what they merge to."""
        if not len(at):
            return
        keys = token[at] << 32 | token[following[at]]
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        for lo, hi, pair in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)], keys[cuts].tolist(), strict=True):
            rank = ranks.pairs.get(pair)
            if rank is not None:
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(heap, rank)
                index[rank].append((pair, at[lo:hi]))

    add(np.flatnonzero(alive & (following < n)))
    while heap:
        rank = heapq.heappop(heap)
        found = []
        for pair, at in index.pop(rank):
            after = following[at]
            at, after = at[ok := alive[at] & (token[at] == pair >> 32) & (after < n)], after[ok]
            found.append(at[token[after] == pair & 0xFFFFFFFF])
        at = np.unique(np.concatenate(found))
        after = following[at]
        linked = np.append(False, at[1:] == after[:-1])[: len(at)]
        if linked.any():
            # Pairs of one rank that overlap, as in a run of equal tokens: from the left, every second one counts.
            group = np.cumsum(~linked) - 1
            even = (np.arange(len(at)) - np.flatnonzero(~linked)[group]) % 2 == 0
            at, after = at[even], after[even]
        if not len(at):
            continue
        beyond = following[after]
        token[at], alive[after], following[at] = rank, False, beyond
        inner = beyond < n
        before[beyond[inner]] = at[inner]
        back = before[at]
        # Two merges side by side both name the pair between them; unique() drops the repetition.
        add(np.unique(np.concatenate([back[back >= 0], at[inner]])))
    ends = np.append(0, np.cumsum(alive))
    return token[alive], ends[bounds]


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices values[starts[i] : starts[i] + lengths[i]], one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    places = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    places += np.arange(total, dtype=kind)
    return values[places]


class Encoder:
    """Encodes texts by the words they consist of, and keeps what it has learnt about words."""

    def __init__(self, ranks: Ranks, pattern: str) -> None:
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self._afresh()

    def _afresh(self) -> None:
        self.slot: dict[str, int] = {}
        self.values = np.zeros(0, np.int64)
        self.offsets = np.zeros(1, np.int64)
        self.kept_bytes = 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of each text's ids."""
        if self.kept_bytes > KEPT_BYTES:
            self._afresh()
        words, counts = [], []
        for text in texts:
            found = self.split(text)
            counts.append(len(found))
            words += found
        slot = self.slot
        fresh = [w for w in dict.fromkeys(words) if w not in slot]
        if fresh:
            slot.update(zip(fresh, range(len(slot), len(slot) + len(fresh)), strict=True))
            values, offsets = replay([w.encode() for w in fresh], self.ranks)
            self.kept_bytes += sum(map(getsizeof, fresh)) + _WORD_BYTES * len(fresh) + values.nbytes
            self.offsets = np.concatenate([self.offsets, offsets[1:] + len(self.values)])
            self.values = np.concatenate([self.values, values])
        at = np.fromiter(map(slot.__getitem__, words), np.int64, len(words))
        starts = self.offsets[at]
        lengths = self.offsets[at + 1] - starts
        ends = np.append(0, np.cumsum(lengths))
        return gathered(self.values, starts, lengths), ends[np.append(0, np.cumsum(counts))]


def decode(ids: np.ndarray, ranks: Ranks) -> bytes:
    """The bytes that the ids stand for."""
    return gathered(ranks.flat, ranks.starts[ids], ranks.lengths[ids]).tobytes()


@lru_cache(maxsize=2)
def _encoder(name: str, pattern: str) -> Encoder:
    with open(SparkFiles.get(name), "rb") as file:
        return Encoder(Ranks(file.read()), pattern)


def pieces(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, a longer row alone."""
    out, first, total = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            out.append((first, i))
            first, total = i, 0
        total += size
    return [*out, (first, len(sizes))] if len(sizes) else []


def with_tokens(
    docs: DataFrame, ranks_file: str, pattern: str, text: str = "text", ids: bool = True, drop: tuple = ()
) -> DataFrame:
    """``docs`` with ``token_ids`` (array<int>, left out unless ``ids``), ``n_tokens`` and two digests.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over the bytes that the
    ids decode to. A null text is an empty one. A text of any length is encoded whole; its task holds its words and ids at once. Rows that
    repeat are encoded alike, and an empty table gives an empty result. ``ranks_file`` is shipped to the executors by Spark. The rank file must
    have all 256 single bytes. Columns of those names are replaced; all others stay.
    """
    docs.sparkSession.sparkContext.addFile(ranks_file)
    name = ranks_file.rstrip("/").rpartition("/")[2]

    def compute(batch: pa.RecordBatch) -> dict:
        encoder = _encoder(name, pattern)
        offsets, data = column_bytes(batch.column(batch.schema.get_field_index(text)))
        view = memoryview(data)
        lists, counts, digests, decoded = [], [], [], []
        for lo, hi in pieces(np.diff(offsets), BLOCK_BYTES):
            texts = [str(view[a:b], "utf-8") for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1], strict=True)]
            flat, bounds = encoder.encode(texts)
            counts.append(np.diff(bounds))
            if ids:
                lists.append(flat.astype(np.int32))
            raw = memoryview(flat.astype("<u4").tobytes())
            plain = memoryview(decode(flat, encoder.ranks))
            places = np.append(0, np.cumsum(encoder.ranks.lengths[flat]))[bounds].tolist()
            for a, b, c, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), places[:-1], places[1:], strict=True):
                digests.append(hashlib.sha256(raw[4 * a : 4 * b]).hexdigest())
                decoded.append(hashlib.sha256(plain[c:d]).hexdigest())
        sizes = np.concatenate(counts)
        out = {"n_tokens": pa.array(sizes, pa.int64()), "ids_sha256": digests, "decoded_sha256": decoded}
        if ids:
            ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            out["token_ids"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists)))
        return out

    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return add_columns(docs, compute, ("token_ids array<int>, " if ids else "") + fields, drop)
