"""The log of published batches: what readers see, and which failures make dead letters."""

import glob
import json
import os

import pytest
from msgflow.operators import USER
from msgflow.sources import ENVELOPE, replay_stream, wide_envelope
from msgflow.streaming import (
    AVAILABLE_NOW,
    ConvertedBatches,
    InferredBatches,
    OutputLog,
    SplitBatches,
    dead_letter_batch,
    is_data_error,
    read_batches,
    read_versions,
    run_batches,
    run_to_end,
)
from msgflow.streaming import published
from msgflow.streaming.published import File, Taken
from pyspark.sql import functions as F


def user(number):
    return f'{{"id":{number},"name":"n","age":{number}}}'


@pytest.fixture
def out(tmp_path):
    return lambda name: str(tmp_path / name)


def test_both_sides_become_visible_at_once(spark, wide, out):
    log, good, bad = OutputLog(out("log")), out("good"), out("bad")
    seen = []

    class Watched(SplitBatches):
        def put(self, rows, side, batch_id, folder=None):
            super().put(rows, side, batch_id, folder)
            seen.append((batch_id, side, log.files(spark).count()))

    write = Watched(USER, good, bad, log=log)
    write(wide(user(1), "bad"), 0)
    write(wide(user(2), user(3), "bad"), 1)
    assert [n for batch_id, _, n in seen if batch_id == 0] == [0, 0]
    assert [n for batch_id, _, n in seen if batch_id == 1] == [log.files(spark, 0).count()] * 2
    assert sorted(r["id"] for r in read_batches(spark, good, log).collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in read_batches(spark, good, log, 0).collect()) == [1]
    assert read_batches(spark, bad, log).count() == 2


def test_a_batch_that_runs_again_takes_the_place_of_the_first(spark, wide, out):
    log, good, bad = OutputLog(out("log")), out("good"), out("bad")
    write = SplitBatches(USER, good, bad, log=log)
    write(wide(user(1), "bad"), 0)
    write(wide(user(2)), 1)
    write(wide(user(7), user(8)), 1)
    assert sorted(r["id"] for r in read_batches(spark, good, log).collect()) == [1, 7, 8]
    assert sorted(r["id"] for r in read_batches(spark, good, log, 1).collect()) == [1, 2]
    write(wide(user(9)).limit(0), 2)
    assert log.latest(spark) == 2


def test_a_failed_attempt_leaves_nothing(spark, wide, out):
    log, good, bad = OutputLog(out("log")), out("good"), out("bad")

    class Fails(SplitBatches):
        def put(self, rows, side, batch_id, folder=None):
            super().put(rows, side, batch_id, folder)
            if side == self.bad_path:
                raise OSError("no space left")

    with pytest.raises(OSError):
        Fails(USER, good, bad, log=log)(wide(user(1), "bad"), 0)
    assert log.latest(spark) == -1 and not glob.glob(f"{good}/**/*.parquet", recursive=True)


def test_published_dead_letters(spark, wide, out):
    log, good, bad, errors = OutputLog(out("log")), out("good"), out("bad"), out("errors")
    fails = [True]

    class Flaky(SplitBatches):
        def process(self, batch, batch_id):
            counts = super().process(batch, batch_id)
            if fails[0]:
                raise ValueError
            return counts

    write = dead_letter_batch(Flaky(USER, good, bad, log=log), errors)
    batch = wide(user(1), "bad")
    write(batch, 0)
    assert read_batches(spark, errors, log).count() == 2 and log.paths(spark, good) == []
    fails[0] = False
    write(batch, 0)
    assert log.paths(spark, errors) == [] and read_batches(spark, good, log).count() == 1
    assert read_batches(spark, errors, log, 0).count() == 2
    with pytest.raises(ValueError, match="no published rows"):
        log.read(spark, errors)
    assert log.read(spark, errors, schema=batch.schema).count() == 0


def test_versions_of_inferred_batches(spark, wide, out):
    log, data, bad = OutputLog(out("log")), out("data"), out("bad")
    for number, text in enumerate(['{"a":1}', '{"a":2.5}', '{"a":3,"b":{"c":1}}', '{"a":"x"}']):
        InferredBatches(data, log=log)(wide(text, "bad"), number)
    assert sorted(str(r["a"]) for r in read_versions(spark, data, log=log).collect()) == ["1", "2.5", "3.0", "None", "None", "None", "None", "x"]
    assert [r["a"] for r in read_versions(spark, data, log=log, version=1).where("a is not null").orderBy("a").collect()] == [1.0, 2.5]
    converted = OutputLog(out("converted-log"))
    write = ConvertedBatches(f"{data}-converted", bad, log=converted)
    write(wide('{"at":"2024-03-22"}', "bad"), 0)
    write(wide("{}", "[]"), 1)
    assert read_versions(spark, f"{data}-converted", log=converted).count() == 2
    assert read_batches(spark, bad, converted).count() == 2


def test_snapshots_from_stored_states(spark, out, monkeypatch):
    monkeypatch.setattr(published, "STATE_EVERY", 3)
    log = OutputLog(out("log"))
    expected = {}
    for version in range(10):
        batch_id = version if version % 4 else max(0, version - 1)  # some batches run again
        log.publish(spark, "q", batch_id, ["a", "b"], [File("a", f"a/{version}", 1), File("b", f"b/{version}", 2)])
        expected = {**expected, batch_id: version}
        for side in ("a", "b"):
            assert log.paths(spark, side) == sorted(f"{side}/{v}" for v in expected.values())
    assert log.paths(spark, "a", 4) == ["a/0", "a/1", "a/2", "a/4"]
    assert len(glob.glob(f"{out('log')}/states/*/_SUCCESS")) == 3
    # A state whose write did not end does not count.
    state = glob.glob(f"{out('log')}/states/8/_SUCCESS")[0]
    os.remove(state)
    assert log.paths(spark, "a") == sorted(f"a/{v}" for v in expected.values())


def test_an_entry_is_created_once(spark, out):
    log, other = OutputLog(out("log")), OutputLog(out("log"))
    log.create(spark, 0, {"run": "q", "batch_id": 0, "sides": ["a"], "files": [], "removed": []})
    with pytest.raises(Taken):
        other.create(spark, 0, {"run": "other", "batch_id": 0, "sides": ["a"], "files": [], "removed": []})
    assert json.loads(open(glob.glob(f"{out('log')}/entries/*.json")[0]).read())["run"] == "q"
    assert not glob.glob(f"{out('log')}/drafts/*")
    # Two queries that share a log publish one after the other, and leave each other's batches alone.
    assert log.publish(spark, "q", 1, ["a"], [File("a", "a/1", 1)]) == 1
    assert other.publish(spark, "other", 1, ["a"], [File("a", "a/2", 1)]) == 2
    assert log.paths(spark, "a") == ["a/1", "a/2"]


def test_replacing_files(spark, out):
    log = OutputLog(out("log"))
    for n in range(3):
        log.publish(spark, "q", n, ["a"], [File("a", f"a/{n}", 1)])
    assert log.replace(spark, 2, [File("a", "a/merged", 2)], ["a/0", "a/1"]) == 3
    assert log.paths(spark, "a") == ["a/2", "a/merged"]
    # The batch ran again between the read and the replacement: the merged file holds what it had before.
    log.publish(spark, "q", 2, ["a"], [File("a", "a/again", 1)])
    assert log.replace(spark, 3, [File("a", "a/stale", 2)], ["a/2", "a/merged"]) is None
    assert log.paths(spark, "a") == ["a/again", "a/merged"]


def test_removing_what_no_version_shows(spark, wide, out):
    log, good, bad = OutputLog(out("log")), out("good"), out("bad")
    write = SplitBatches(USER, good, bad, log=log)
    for number in (1, 2, 3):
        write(wide(user(number)), 0)
    assert log.remove_unseen(spark, 1) > 0
    assert [r["id"] for r in read_batches(spark, good, log).collect()] == [3]
    assert [r["id"] for r in read_batches(spark, good, log, 1).collect()] == [2]
    with pytest.raises(Exception):
        read_batches(spark, good, log, 0).collect()


def test_streams_publish_every_batch_once(spark, tmp_path, out):
    rows = [(b"k", user(n).encode() if n % 3 else b"bad", "t", 0, n, None, 0) for n in range(9)]
    for n in range(3):
        spark.createDataFrame(rows[n * 3 : n * 3 + 3], ENVELOPE).coalesce(1).write.mode("append").parquet(out("topic"))
    log, good, bad = OutputLog(out("log")), out("good"), out("bad")
    messages = wide_envelope(replay_stream(spark, out("topic"), files_per_trigger=1))
    write = SplitBatches(USER, good, bad, log=log)
    stops = [True]

    def breaks_off(batch, batch_id):
        write(batch.drop("kafka_topic"), batch_id)
        if batch_id == 1 and stops:
            stops.clear()
            raise RuntimeError

    for _ in range(2):
        try:
            run_to_end(run_batches(messages, breaks_off, out("checkpoint"), trigger=AVAILABLE_NOW))
        except Exception:
            assert log.latest(spark) == 1
    assert log.latest(spark) == 3
    assert sorted(r["id"] for r in read_batches(spark, good, log).collect()) == [1, 2, 4, 5, 7, 8]
    assert read_batches(spark, bad, log).count() == 3


# Failures


def failure(run):
    try:
        run()
    except Exception as error:
        return error
    raise AssertionError("no failure")


def test_data_errors(spark, tmp_path):
    texts = spark.createDataFrame([("1",), ("x",)], "text string")
    bad_cast = texts.selectExpr("cast(text as int) as n")

    @F.udf("int")
    def refuses(text):
        raise KeyError(text)

    def each(batches):
        raise ValueError("a batch that can not be read")

    for run in (
        bad_cast.collect,
        lambda: bad_cast.write.parquet(str(tmp_path / "cast")),
        lambda: texts.select("no_such_column"),
        lambda: texts.select(F.raise_error(F.lit("refused"))).write.parquet(str(tmp_path / "raised")),
        lambda: texts.select(refuses("text")).write.parquet(str(tmp_path / "udf")),
        lambda: texts.mapInArrow(each, "text string").collect(),
        lambda: texts.selectExpr("1 / (length(text) - 1)").collect(),
        lambda: {}["missing"],
        lambda: int("x"),
    ):
        assert is_data_error(failure(run))


def test_failures_of_the_cluster(spark, tmp_path):
    gone = str(tmp_path / "gone")
    spark.range(10).write.parquet(gone)
    rows = spark.read.parquet(gone)
    for file in glob.glob(f"{gone}/*.parquet"):
        os.remove(file)
    (tmp_path / "file").write_text("a file, not a folder")

    def lost_worker(batches):
        os._exit(1)

    def raises(kind):
        def run():
            raise kind("from the system")

        return run

    for run in (
        rows.collect,
        lambda: spark.range(10).write.parquet(str(tmp_path / "file" / "below")),
        lambda: spark.range(3).mapInArrow(lost_worker, "id long").collect(),
        raises(OSError),
        raises(MemoryError),
        raises(ConnectionError),
        raises(TimeoutError),
    ):
        assert not is_data_error(failure(run))


def test_a_failure_of_the_cluster_leaves_no_dead_letter(spark, wide, out):
    log, good, bad, errors = OutputLog(out("log")), out("good"), out("bad"), out("errors")

    class LosesItsDisk(SplitBatches):
        def process(self, batch, batch_id):
            super().process(batch, batch_id)
            raise OSError

    for log_used in (None, log):
        with pytest.raises(OSError):
            dead_letter_batch(LosesItsDisk(USER, good, bad, log=log_used), errors)(wide(user(1)), 0)
        assert not glob.glob(f"{errors}/**/*.parquet", recursive=True)
    assert log.latest(spark) == -1


@pytest.mark.parametrize("kind, most", [("split", 3), ("inferred", 3), ("converted", 5)])
def test_jobs_of_a_batch(spark, wide, out, kind, most):
    log = OutputLog(out("log"))
    write = {
        "split": lambda: SplitBatches(USER, out("good"), out("bad"), log=log),
        "inferred": lambda: InferredBatches(out("data"), log=log),
        "converted": lambda: ConvertedBatches(out("data"), out("bad"), log=log),
    }[kind]()
    batch = wide('{"id":1,"name":"n","at":"2024-03-22"}', "bad", '{"id":2,"name":"m","at":"2024-03-23"}')
    write(batch, 0)
    spark.sparkContext.setJobGroup(f"counted {kind}", "one more batch")
    try:
        write(batch, 1)
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"counted {kind}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= most
