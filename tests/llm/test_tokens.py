import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from edge import SCHEMA, clashing, rows_of, with_edges
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from msgflow.llm import bpe
from msgflow.llm.queries import op2_token_files, op7_byte_bpe
from msgflow.llm.tables import shared_folder
from msgflow.llm.tokenfile import Reader, WordTokens, Writer, pack, read_token_files, store_uri, unpack, write_token_files

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n):
    rng = random.Random(7)
    letters = " \n\t\r'sdlaA=-0é漢😀́ \u0085\x1cǅ٣ "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(n)] + ["-" * k for k in range(70)]


def test_replay_equals_the_library():
    encoding = reference()
    encoder = bpe.Encoder(bpe.Ranks(open(RANKS, "rb").read()), public_tokenizers.PATTERN)
    texts = odd_texts(800)
    flat, bounds = encoder.encode(texts)
    for k, text in enumerate(texts):
        ids = flat[bounds[k] : bounds[k + 1]]
        assert ids.tolist() == encoding.encode_ordinary(text), text
        assert bpe.decode(ids, encoder.ranks) == text.encode()


def test_replay_takes_equal_ranks_from_the_left():
    """``aaa`` can be made of ``a`` + ``aa`` and of ``aa`` + ``a``; where both overlap, the left one counts."""
    tokens = [bytes([b]) for b in range(256)] + [b"aa", b"aaa"]
    lines = b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens))
    ranks = bpe.Ranks(lines)
    encoding = tiktoken.Encoding("t", pat_str=r".+", mergeable_ranks=ranks.ids, special_tokens={})
    words = [b"a" * n for n in range(1, 30)] + [b"ab" * 3 + b"aaaa" + b"b", b""]
    values, offsets = bpe.replay(words, ranks)
    for k, word in enumerate(words):
        assert values[offsets[k] : offsets[k + 1]].tolist() == encoding.encode_ordinary(word.decode()), word


def test_tokens_of_all_rows(spark, sf_dir):
    docs = clashing(with_edges(spark, sf_dir), "n_tokens", "TOKEN_IDS")
    found = bpe.with_tokens(docs, RANKS, public_tokenizers.PATTERN)
    encoding = reference()
    expected = []
    for r in docs.select("doc_id", "text").collect():
        raw = np.array(encoding.encode_ordinary(r.text or ""), "<u4")
        digests = [hashlib.sha256(x).hexdigest() for x in (raw.tobytes(), (r.text or "").encode())]
        expected.append((r.doc_id, len(raw), *digests))
    assert rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert found.where("size(token_ids) != n_tokens").count() == 0
    assert bpe.with_tokens(spark.createDataFrame([], SCHEMA), RANKS, public_tokenizers.PATTERN).collect() == []
    assert op7_byte_bpe(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400))
def test_words_round_trip(ids):
    words, raw = pack(np.array(ids, np.uint64))
    assert unpack(words, raw).tolist() == ids


def test_words_are_dense():
    assert len(pack(np.zeros(240, np.uint64))[0]) == 2
    assert len(pack(np.full(40, 2**15 - 1, np.uint64))[0]) == 10
    assert len(pack(np.array([2**60 - 1, 2**60], np.uint64))[0]) == 3


def test_word_tokens_equal_the_library():
    library, mine = Tokenizer.from_file(JSON), WordTokens(JSON)
    texts = [*odd_texts(600), "<|endoftext|>", "a <|endoftext|>b", "it's we'll  x y", ""]
    flat, bounds = mine.encode(texts)
    for k, text in enumerate(texts):
        assert flat[bounds[k] : bounds[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_file_with_raw_words_and_spanning_documents(tmp_path):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 1 << 62, n, dtype=np.uint64) for n in (0, 5, 200_000, 0, 70_000)]
    writer = Writer(str(tmp_path), "x.s8b")
    for i, ids in enumerate(docs):
        writer.add([None if i == 1 else i], [len(ids)], ids)
    writer.close()
    reader = Reader(str(tmp_path), "x.s8b")
    assert [d.tolist() for d in reader.documents()] == [d.tolist() for d in docs]
    assert reader.nulls.tolist() == [False, True, False, False, False]
    assert reader.block(2).tolist() == np.concatenate(docs)[2 << 16 : 3 << 16].tolist()


def test_files_of_all_rows(spark, sf_dir):
    docs = clashing(with_edges(spark, sf_dir), "start", "tie", "id")
    folder = shared_folder(spark, "test-tokens")
    found = read_token_files(spark, folder, write_token_files(docs, folder, JSON)).collect()
    library = Tokenizer.from_file(JSON)
    expected = []
    for r in docs.select("doc_id", "text").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r[0], r[2], r[3]) for r in found), key=repr) == sorted(expected, key=repr)
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    folder = shared_folder(spark, "test-none")
    assert read_token_files(spark, folder, write_token_files(spark.createDataFrame([], SCHEMA), folder, JSON)).collect() == []
    assert op2_token_files(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_kept_words_are_bound_by_bytes(monkeypatch):
    """Texts with unusual characters leave nothing behind, and long words count by their bytes."""
    from tokenizers import Tokenizer

    from msgflow.llm import tokenfile

    library, mine = Tokenizer.from_file(JSON), WordTokens(JSON)

    def same(texts):
        ids, bounds = mine.encode(texts)
        expected = library.encode_batch(texts, add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [e.ids for e in expected]

    for k in range(20):
        same([f"text {n % 3} — “quoted” 漢字 🙂 " * 5 + str(k) for n in range(10)] + ["", "plain words", f"<|endoftext|> {k}"])
    assert len(mine.slot) < 10 and mine.kept_bytes < 10_000
    monkeypatch.setattr(tokenfile, "_KEPT_BYTES", 100_000)
    for k in range(20):
        same([f"{letter}" * (20_000 + k) for letter in "abc"] + ["naïve — words"])
        assert sum(map(len, mine.slot)) < 200_000


def test_schemes_of_the_shared_folder():
    for scheme in ("s3", "s3a", "s3n"):
        assert store_uri(f"{scheme}://bucket/a/s3a://b") == "s3://bucket/a/s3a://b"
    for folder in ("file:/tmp/x", "hdfs://host/x", "abfss://c@a.example/x", "/tmp/s3a"):
        assert store_uri(folder) == folder
