"""Compaction in place: what is read, what readers see meanwhile, and batches that run again."""

import glob

import pytest
from hypothesis import given
from hypothesis import strategies as st
from msgflow.operators import USER
from msgflow.streaming import InferredBatches, OutputLog, SplitBatches, compact_published, read_versions
from msgflow.streaming import published_compaction
from msgflow.streaming.published_compaction import Compaction, bins


def user(number):
    return f'{{"id":{number},"name":"n","age":{number}}}'


@given(st.lists(st.tuples(st.integers(1, 120), st.booleans()), max_size=40))
def test_bins_keep_to_the_target(files):
    files = [(f"f{i}", size, merged) for i, (size, merged) in enumerate(files)]
    sizes = {path: (size, merged) for path, size, merged in files}
    found = bins(files, 100)
    paths = [path for held in found for path in held]
    assert len(paths) == len(set(paths)) and all(sizes[path][0] < 75 for path in paths)
    for held in found:
        total = sum(sizes[path][0] for path in held)
        assert total <= 100 and len(held) > 1
        assert total >= 75 or sum(not sizes[path][1] for path in held) > 1
    # If the products of the merges have the sizes of their parts, nothing is left to do.
    merged = [(f"m{i}", sum(sizes[path][0] for path in held), True) for i, held in enumerate(found)]
    rest = [file for file in files if file[0] not in set(paths)]
    again = bins([*merged, *rest], 100)
    assert all(sum(dict((p, s) for p, s, _ in [*merged, *rest])[path] for path in held) >= 75 for held in again)


@pytest.fixture
def split(spark, wide, tmp_path):
    log, good, bad = OutputLog(str(tmp_path / "log")), str(tmp_path / "good"), str(tmp_path / "bad")
    return log, good, bad, SplitBatches(USER, good, bad, log=log)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_small_files_only_and_each_row_once(spark, wide, split, monkeypatch):
    log, good, bad, write = split
    assert compact_published(spark, log, good) == Compaction(None, 0, 0, 0)
    for number in range(5):
        write(wide(user(number), "bad"), number)
    files = {r["path"]: r["bytes"] for r in log.files(spark).where(f"side = '{good}'").collect()}
    before = log.read(spark, good)  # a reader that has begun
    during = []
    replace = OutputLog.replace

    def watched(self, *args):
        during.append(ids(log.read(spark, good)))
        return replace(self, *args)

    monkeypatch.setattr(OutputLog, "replace", watched)
    done = compact_published(spark, log, good)
    last = [path for path in files if "/batch_id=4/" in path]
    assert done.files_read == len(files) - len(last) and done.files_written == 1
    assert done.bytes_read == sum(size for path, size in files.items() if path not in last)
    assert ids(before) == ids(log.read(spark, good)) == during[0] == [0, 1, 2, 3, 4]
    assert len(log.paths(spark, good)) == 1 + len(last) and log.read(spark, bad).count() == 5
    assert compact_published(spark, log, good) == Compaction(None, 0, 0, 0)
    # The last batch runs again after the merge: it was not part of it.
    write(wide(user(9)), 4)
    assert ids(log.read(spark, good)) == [0, 1, 2, 3, 9]
    assert ids(log.read(spark, good, done.version)) == [0, 1, 2, 3, 4]


def test_a_merge_is_given_up_if_a_batch_runs_again(spark, wide, split, monkeypatch):
    log, good, bad, write = split
    for number in range(3):
        write(wide(user(number)), number)
    replace = OutputLog.replace

    def late(self, *args):
        write(wide(user(77)), 1)
        return replace(self, *args)

    monkeypatch.setattr(OutputLog, "replace", late)
    assert compact_published(spark, log, good).version is None
    assert ids(log.read(spark, good)) == [0, 2, 77]
    assert not [f for f in glob.glob(f"{good}/run=replaced/**/*.parquet", recursive=True)]


def test_files_of_the_target_size_are_left_alone(spark, wide, split):
    log, good, bad, write = split
    for number in range(4):
        write(wide(user(number)), number)
    assert compact_published(spark, log, good, target_bytes=100).version is None
    assert published_compaction.FULL_SHARE < 1


def test_versions_are_merged_apart_with_all_their_fields(spark, wide, tmp_path):
    log, path = OutputLog(str(tmp_path / "log")), str(tmp_path / "data")
    texts = ['{"a":1}', '{"a":2,"b":"x"}', '{"a":3,"c":{"d":1}}', '{"a":2.5}', '{"a":4,"e":true}', '{"a":5}']
    for number, text in enumerate(texts):
        InferredBatches(path, log=log)(wide(text), number)
    before = read_versions(spark, path, log=log)
    rows = sorted(map(str, before.collect()))
    assert compact_published(spark, log, path).version is not None
    after = read_versions(spark, path, log=log)
    assert before.schema == after.schema and sorted(map(str, after.collect())) == rows
    assert len(log.paths(spark, path)) < len(texts) * 3
