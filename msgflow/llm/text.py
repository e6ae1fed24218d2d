"""Words of Arrow text columns as runs of bytes with 64-bit hashes, computed over blocks of bytes.

A block is about a quarter of a megabyte, whatever the documents' lengths: many short documents, or a piece of a long one,
cut at white space. So the arrays of a task have a bound that does not depend on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18

SPACE, LETTER, UPPER, DIGIT, SIGN = range(5)
_BYTES = np.arange(256)
#: The kind of each byte: bytes above 127 are parts of letters here.
KINDS = np.select(
    [
        (_BYTES <= 32) | (_BYTES == 127),
        ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128),
        (_BYTES >= 65) & (_BYTES <= 90),
        (_BYTES >= 48) & (_BYTES <= 57),
    ],
    [SPACE, LETTER, UPPER, DIGIT],
    SIGN,
).astype(np.uint8)
#: Kinds for words without regard to case and signs: letters and digits against the rest.
WORDS = np.where((KINDS == SPACE) | (KINDS == SIGN), 0, 1).astype(np.uint8)

_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values over all positions."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null is empty."""
    if pa.types.is_null(column.type):
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    array = pc.fill_null(column.cast(pa.large_string()).cast(pa.large_binary()), b"")
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


class Block(NamedTuple):
    first: int  # of the block's documents, in the column
    offsets: np.ndarray
    data: np.ndarray


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The documents of a column in blocks of about ``size`` bytes; a longer one comes in several blocks."""
    offsets, data = column_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        begin, end = int(offsets[first]), int(offsets[last])
        if end - begin <= size:
            yield Block(first, offsets[first : last + 1] - begin, data[begin:end])
        else:
            while begin < end:
                stop = min(end, begin + size)
                if stop < end and len(spaces := np.flatnonzero(KINDS[data[begin:stop]] == SPACE)):
                    stop = begin + int(spaces[-1]) + 1
                yield Block(first, np.array([0, stop - begin]), data[begin:stop])
                begin = stop
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes in lower case: A-Z, and the letters of Latin-1 as UTF-8 writes them."""
    out = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    if len(out) > 1:
        low = out[1:]
        accented = (out[:-1] == 0xC3) & (low >= 0x80) & (low <= 0x9E) & (low != 0x97)
        low[accented] += 32
    return out


class Runs(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray  # in the block, ascending
    hashes: np.ndarray


def runs(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> Runs:
    """The maximal runs of bytes of one kind (kind 0 separates), within documents, with their hashes."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, np.zeros(0, np.uint64))
    kind = kinds[data]
    new = np.empty(n + 1, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:n])
    new[offsets] = True
    starts = np.flatnonzero(new[:n])
    ends = np.append(starts[1:], n)
    keep = kind[starts] > 0
    starts, ends = starts[keep], ends[keep]
    length = max(BLOCK_BYTES, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_FACTOR, length)[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, length)[starts])
    docs = np.searchsorted(offsets, starts, "right") - 1
    return Runs(starts, ends, docs, hashes)


def first_of_docs(docs: np.ndarray) -> np.ndarray:
    """Positions at which a new number begins in an ascending array of numbers of documents (or contexts)."""
    return np.flatnonzero(np.append(True, docs[1:] != docs[:-1])) if len(docs) else np.zeros(0, np.int64)
