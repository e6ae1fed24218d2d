"""Token-id files: Simple-8b words of 64 bits, written and read by Spark tasks.

Fixed layout of a file, all numbers little-endian:

    magic "S8BWORD1"
    blocks of up to BLOCK_IDS ids: the words (u64), then the positions of the raw words among them (u32)
    block index: for each block its byte offset (u64), ids (u32), words (u32), raw words (u32)
    document index: doc_id (i64) of each document, ids (i64) of each, 1 where doc_id is null (u8)
    footer: byte offset of the block index (u64), blocks (u64), documents (u64), magic

The top four bits of a word select how many ids of how many bits the lower 60 hold. Selector 0 is the escape: it holds
nothing, and the next word is an id of more than 60 bits as it is. The position list tells raw words from packed ones,
so that all words of a block are decoded at once, selector by selector. A document may span blocks.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, count, islice
from operator import itemgetter
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import gathered, pieces
from .text import column_bytes

MAGIC = b"S8BWORD1"
BLOCK_IDS = 1 << 16
#: Ids per word and bits per id of selectors 1 to 15. Fixed values of the format.
COUNTS = np.array([0, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: Bits of the numbers below 2**16.
_BITS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)
_TEXT_BYTES = 2 << 20
#: Bytes of words and their ids that a task keeps before it starts afresh; besides the text a word takes so many.
_KEPT_BYTES, _WORD_BYTES = 240_000_000, 140


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of ids (unsigned 64-bit), and the positions of the raw words among them.

    Each word takes as many of the next ids as any selector can, from the left.
    """
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    if ids.max() < len(_BITS):
        bits = _BITS[ids]
    else:
        bits = np.minimum(np.frexp(ids.astype(np.float64))[1], 60).astype(np.uint8)
        bits[ids >> np.uint64(60) > 0] = 61
    best = np.where(bits > 60, 0, 15).astype(np.uint8)
    widest, size = bits.copy(), 1  # the most bits among the next ``size`` ids
    for selector in range(14, 0, -1):
        count, width = int(COUNTS[selector]), WIDTHS[selector]
        if count > n or widest.min() > width:
            break
        while size < count:
            widest = np.maximum(widest[:-1], bits[size:])
            size += 1
        best[: len(widest)][widest <= width] = selector
    # From each place the next word's begin; the walk over them takes 16 words at a step, and the words between are looked up together.
    following = np.append(np.minimum(np.arange(n) + np.maximum(COUNTS[best], 1), n), n)
    leap = following
    for _ in range(4):
        leap = leap[leap]
    leaps, begins, at = memoryview(leap), [], 0
    while at < n:
        begins.append(at)
        at = leaps[at]
    rows = [np.array(begins)]
    while len(rows) < 16:
        rows.append(following[rows[-1]])
    starts = np.stack(rows, 1).ravel()
    starts = starts[starts < n]
    chosen = best[starts]
    raw = chosen == 0
    places = np.arange(len(starts)) + np.cumsum(raw) - raw
    words = np.zeros(len(starts) + int(raw.sum()), np.uint64)
    words[places[raw] + 1] = ids[starts[raw]]
    for selector in np.unique(chosen[~raw]).tolist():
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        mine = chosen == selector
        word = np.full(int(mine.sum()), selector << 60, np.uint64)
        if width:
            for k in range(count):
                word |= ids[starts[mine] + k] << np.uint64(k * width)
        words[places[mine]] = word
    return words, (places[raw] + 1).astype(np.uint32)


def unpack(words: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The ids of the words of a block."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    selectors[raw] = -1
    counts = np.where(selectors < 0, 1, COUNTS[selectors])
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    out[starts[raw]] = words[raw]
    for selector in np.unique(selectors[selectors > 1]).tolist():
        width = int(WIDTHS[selector])
        mine = selectors == selector
        mask = np.uint64((1 << width) - 1)
        for k in range(int(COUNTS[selector])):
            out[starts[mine] + k] = words[mine] >> np.uint64(k * width) & mask
    return out


def store_uri(folder: str) -> str:
    """A folder in the words of Arrow's file systems, which know Hadoop's schemes for S3 by another name."""
    return re.sub(r"^s3[an]://", "s3://", folder)


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(store_uri(folder))


class Writer:
    """Writes one file; it appears under its name when it is complete."""

    def __init__(self, folder: str, name: str) -> None:
        self.fs, self.folder = _store(folder)
        self.name, self.draft = name, f"{self.folder}/_{name}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.folder, recursive=True)
        self.out = self.fs.open_output_stream(self.draft)
        self.out.write(MAGIC)
        self.blocks: list[bytes] = []
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0

    def add(self, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> None:
        """Documents with the numbers of their ids, and all their ids one after the other."""
        self.doc_ids += doc_ids
        self.sizes += sizes
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            self._flush(self.n_waiting // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting)
        for at in range(0, n, BLOCK_IDS):
            part = ids[at : min(n, at + BLOCK_IDS)]
            words, raw = pack(part)
            self.blocks.append(struct.pack("<QIII", self.out.tell(), len(part), len(words), len(raw)))
            self.out.write(words.astype("<u8").tobytes() + raw.astype("<u4").tobytes())
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        if self.n_waiting:
            self._flush(self.n_waiting)
        at = self.out.tell()
        self.out.write(b"".join(self.blocks))
        self.out.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array(self.sizes, "<i8").tobytes())
        self.out.write(np.array([d is None for d in self.doc_ids], np.uint8).tobytes())
        self.out.write(struct.pack("<QQQ", at, len(self.blocks), len(self.doc_ids)) + MAGIC)
        self.out.close()
        self.fs.move(self.draft, f"{self.folder}/{self.name}")


class Reader:
    """Reads one file: its documents, and its ids block by block from any block on."""

    def __init__(self, folder: str, name: str) -> None:
        self.fs, path = _store(folder)
        self.file = self.fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        at, n_blocks, n_docs, magic = struct.unpack("<QQQ8s", self.file.read_at(32, size - 32))
        if magic != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{name} is not a complete token file")
        index = self.file.read_at(size - 32 - at, at)
        self.blocks = [struct.unpack_from("<QIII", index, 20 * i) for i in range(n_blocks)]
        index = memoryview(index)[20 * n_blocks :]
        self.doc_ids = np.frombuffer(index, "<i8", n_docs)
        self.sizes = np.frombuffer(index, "<i8", n_docs, 8 * n_docs)
        self.nulls = np.frombuffer(index, np.uint8, n_docs, 16 * n_docs).astype(bool)

    def block(self, i: int) -> np.ndarray:
        at, n_ids, n_words, n_raw = self.blocks[i]
        data = self.file.read_at(8 * n_words + 4 * n_raw, at)
        ids = unpack(np.frombuffer(data, "<u8", n_words), np.frombuffer(data, "<u4", n_raw, 8 * n_words))
        if len(ids) != n_ids:
            raise ValueError("a block does not hold the ids that its index names")
        return ids

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document, in the order of the file."""
        held, next_block = np.zeros(0, np.uint64), 0
        for size in self.sizes.tolist():
            parts, have = [held], len(held)
            while have < size:
                parts.append(self.block(next_block))
                have += len(parts[-1])
                next_block += 1
            joined = np.concatenate(parts) if len(parts) > 1 else held
            yield joined[:size]
            held = joined[size:]

    def close(self) -> None:
        self.file.close()


#: Splits texts of plain characters as the library's own pattern for this kind of vocabulary does: letters or digits or signs
#: with a space before them, contractions, white space. Plain are the characters up to U+024F but for rare white space and numbers.
_PLAIN_WORDS = re.compile(
    r" ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\sA-Za-z0-9ªµºÀ-ÖØ-öø-ɏ]+|\s+(?!\S)|\s+"
)
#: Texts with other characters, or with what may be the mark of a special token, go to the library whole.
_UNUSUAL = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")
_JOINED_WORDS = 500


class WordTokens:
    """Encodes texts with the tokenizers library, each distinct word once.

    The library splits a text into words by a pattern and merges within words only, so a text's ids are those of
    its words. Texts with unusual characters are left to the library whole, and not kept.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self._afresh()

    def _afresh(self) -> None:
        self.slot: dict[str, int] = defaultdict(count().__next__)
        self.values, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.kept_bytes = 0

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words as the library gives them, and their offsets.

        Words of a space and letters stay apart when they are joined, so many of them are encoded as one text.
        """
        joins = [len(w) > 1 and w[0] == " " and w[1:].isalpha() for w in words]
        plain = list(compress(words, joins))
        texts = ["".join(plain[i : i + _JOINED_WORDS]) for i in range(0, len(plain), _JOINED_WORDS)]
        found, sizes = [], np.zeros(len(words), np.int64)
        owner = []
        for k, e in enumerate(self.library.encode_batch(texts, add_special_tokens=False)):
            found.append(np.array(e.ids, np.uint32))
            owner.append(np.array(e.word_ids, np.int64) + k * _JOINED_WORDS)
        joins = np.array(joins, bool)
        if found:
            sizes[joins] = np.bincount(np.concatenate(owner), minlength=len(plain))
        single = self.library.encode_batch_fast(list(compress(words, ~joins)), add_special_tokens=False)
        sizes[~joins] = [len(e) for e in single]
        ends = np.append(0, np.cumsum(sizes))
        out = np.zeros(int(ends[-1]), np.uint32)
        mine = np.repeat(joins, sizes)
        if found:
            out[mine] = np.concatenate(found)
        out[~mine] = np.fromiter((i for e in single for i in e.ids), np.uint32)
        return out, ends

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of each text's ids."""
        if self.kept_bytes > _KEPT_BYTES:
            self._afresh()
        words, counts, places, unusual = [], [], [], []
        for text in texts:
            if "<|" in text or _UNUSUAL.search(text):
                places.append(len(words))
                unusual.append(text)
                found = [""]  # holds the place of the whole text
            else:
                found = _PLAIN_WORDS.findall(text)
            counts.append(len(found))
            words += found
        known = len(self.slot)
        # Looking a word up gives a new one the next slot.
        found = itemgetter(*words)(self.slot) if len(words) > 1 else map(self.slot.__getitem__, words)
        at = np.fromiter(found, np.int64, len(words))
        if len(self.slot) > known:
            new = list(islice(self.slot, known, None))
            values, offsets = self._ids(new)
            self.kept_bytes += sum(map(getsizeof, new)) + _WORD_BYTES * len(new) + values.nbytes
            self.offsets = np.concatenate([self.offsets, offsets[1:] + len(self.values)])
            self.values = np.concatenate([self.values, values])
        starts = self.offsets[at]
        lengths = self.offsets[at + 1] - starts
        values = self.values
        if unusual:
            texts_at: dict[str, int] = defaultdict(count().__next__)
            mine = np.array([texts_at[text] for text in unusual])  # a text that repeats is encoded once
            encoded = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(list(texts_at), add_special_tokens=False)]
            bounds = len(values) + np.append(0, np.cumsum([len(e) for e in encoded]))
            starts[places], lengths[places] = bounds[mine], bounds[mine + 1] - bounds[mine]
            values = np.concatenate([values, *encoded])
        ends = np.append(0, np.cumsum(lengths))
        return gathered(values, starts, lengths), ends[np.append(0, np.cumsum(counts))]


@lru_cache(maxsize=2)
def _tokens(name: str) -> WordTokens:
    return WordTokens(SparkFiles.get(name))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_file: str, end_id: int | None = 0, id_col: str = "doc_id", text: str = "text"
) -> list[tuple[str, int, int]]:
    """Writes the ids of all texts below ``folder`` in ascending order of ``id_col``; returns (file, documents, ids).

    Rows are dealt by ranges of the id, a file for each range, so the files in order hold the documents in order.
    After each document comes ``end_id``, unless it is None. A null text is empty. Null ids come first; rows that repeat an
    id follow each other in the order of a hash of their texts, and so can be dealt to several files. An empty table gives
    no file. The returned list has a row per file. A task that runs again writes the same file again.
    """
    docs.sparkSession.sparkContext.addFile(tokenizer_file)
    tokenizer = tokenizer_file.rstrip("/").rpartition("/")[2]
    order = ["id", "tie"]
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, part = None, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or Writer(folder, f"part-{part:06d}.s8b")
            ids = batch.column("id").to_pylist()
            offsets, data = column_bytes(batch.column("text"))
            view = memoryview(data)
            for lo, hi in pieces(np.diff(offsets), _TEXT_BYTES):
                texts = [str(view[a:b], "utf-8") for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1], strict=True)]
                found, bounds = _tokens(tokenizer).encode(texts)
                if end_id is not None:
                    found = np.insert(found, bounds[1:], np.uint32(end_id))
                    bounds = bounds + np.arange(len(bounds))
                writer.add(ids[lo:hi], np.diff(bounds).tolist(), found)
        if writer:
            writer.close()
            row = [[part], [writer.name], [len(writer.sizes)], [writer.n_ids]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.int32()), pa.array(row[1]), pa.array(row[2], pa.int64()), pa.array(row[3], pa.int64())],
                names=["part", "file", "n_docs", "n_ids"],
            )

    files = rows.mapInArrow(write, "part int, file string, n_docs bigint, n_ids bigint").collect()
    return [(f["file"], f["n_docs"], f["n_ids"]) for f in sorted(files, key=lambda f: f["part"])]


def read_token_files(spark: SparkSession, folder: str, files: list[tuple[str, int, int]], id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of all documents in the files, from the decoded ids.

    ``start`` is the number of ids of all documents before; ``ids_crc32`` is over the ids as little-endian unsigned
    32-bit integers.
    """
    starts = np.cumsum([0, *(n for _, _, n in files)])[:-1].tolist()
    table = spark.createDataFrame(
        [(name, start) for (name, _, _), start in zip(files, starts, strict=True)], "file string, start bigint"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                reader = Reader(folder, name)
                crcs = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in reader.documents()]
                sizes = reader.sizes.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids.astype(np.int64), mask=reader.nulls),
                        pa.array(start + np.cumsum(sizes) - sizes),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=[id_col, "start", "n_tokens", "ids_crc32"],
                )
                reader.close()

    table = table.repartition(max(1, len(files)))
    return table.mapInArrow(read, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
