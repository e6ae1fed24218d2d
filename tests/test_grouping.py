"""Groups that close when full or idle: the cut of a batch against a plain loop, and a stream with restarts."""

import datetime

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from msgflow.sources import ENVELOPE, replay_stream, wide_envelope
from msgflow.streaming import AVAILABLE_NOW, grouped_messages, parquet_stream, run_to_end
from msgflow.streaming.grouping import closed_groups


def plain_groups(messages, size, idle):
    """The closed groups and the open one of (offset, time) messages, one after the other."""
    out, held, number = [], [], 0

    def close(reason):
        nonlocal held, number
        out.append((number, held[0][0], held[-1][0], len(held), reason))
        held, number = [], number + 1

    for message in messages:
        if held and message[1] - held[-1][1] > idle:
            close("idle")
        held.append(message)
        if len(held) == size:
            close("count")
    return out, (number, held[0][0], held[-1][0], len(held), held[-1][1]) if held else None


@settings(deadline=None, max_examples=300)
@given(
    st.lists(st.sampled_from([0, 1, 2, 5, 9]), min_size=1, max_size=40),
    st.integers(1, 6),
    st.sampled_from([0, 1, 4, 8]),
    st.lists(st.integers(1, 8)),
)
def test_batches_cut_anywhere(pauses, size, idle, cuts):
    times = np.cumsum(pauses)
    messages = [(2 * i, int(t)) for i, t in enumerate(times)]
    state, found, rest = (0, 0, 0, 0, 0), [], messages
    for cut in (*cuts, len(messages)):
        part, rest = rest[:cut], rest[cut:]
        if part:
            rows, still, following = closed_groups(state, *(np.array(c) for c in zip(*part)), size, idle)
            found += rows.itertuples(index=False, name=None)
            state = still or (following, 0, 0, 0, part[-1][1])
    closed, still = plain_groups(messages, size, idle)
    assert found == closed and (state if state[3] else None) == still


def test_a_stream_with_restarts(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))
    begin = datetime.datetime(2024, 1, 1)

    def run(*messages):
        rows = [(None, None, "t", p, o, begin + datetime.timedelta(seconds=s), 0) for p, o, s in messages]
        spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(topic)
        wide = wide_envelope(replay_stream(spark, topic))
        groups = grouped_messages(wide, size=3, idle="10 seconds")
        run_to_end(parquet_stream(groups, out, checkpoint, trigger=AVAILABLE_NOW))
        found = spark.read.parquet(out).select("kafka_partition", "group_no", "first_offset", "last_offset", "messages", "closed_by")
        return sorted(map(tuple, found.collect()))

    assert run((0, 0, 0), (0, 1, 1)) == []
    # The third message fills the group that was open before the restart.
    first = run((0, 2, 5), (0, 3, 6), (1, 0, 7))
    assert first == [(0, 0, 0, 2, 3, "count")]
    # Partition 1 goes on after a pause; partition 0 is silent, and its group closes once the watermark has passed.
    second = run((1, 1, 30), (1, 2, 31))
    assert second == sorted([*first, (1, 0, 0, 0, 1, "idle"), (0, 1, 3, 3, 1, "idle")])
    assert run((0, 4, 31), (0, 5, 32), (0, 6, 33)) == sorted([*second, (0, 2, 4, 6, 3, "count")])
