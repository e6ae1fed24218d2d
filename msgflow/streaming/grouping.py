"""Messages in groups that close when they are full, or when nothing more has come for a while."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CLOSED = (
    "kafka_topic string, kafka_partition int, group_no bigint, first_offset bigint, last_offset bigint, messages bigint, closed_by string"
)
_OPEN = "group_no bigint, first_offset bigint, last_offset bigint, messages bigint, last_micros bigint"


def closed_groups(
    open_group: tuple[int, int, int, int, int] | None, offsets: np.ndarray, micros: np.ndarray, size: int, idle_micros: int
) -> tuple[pd.DataFrame, tuple[int, int, int, int, int] | None, int]:
    """The groups that messages close, the group that is open behind them, and the number of the next group.

    Messages come in the order of their offsets. A group closes by ``count`` with its last message, and by ``idle`` if the next message is more
    than ``idle_micros`` later than its last one.
    """
    number, first, last, held, last_micros = open_group or (0, 0, 0, 0, 0)
    n = len(offsets)
    pauses = np.diff(micros, prepend=last_micros) > idle_micros
    pauses[0] &= held > 0
    run = np.cumsum(pauses)  # the stretch between pauses that each message is in; 0 goes on with the open group
    starts = np.append(0, np.flatnonzero(pauses))
    run_start = np.zeros(int(run[-1]) + 1, np.int64)
    run_start[run[starts]] = starts
    place = np.arange(n) - run_start[run] + np.where(run == 0, held, 0)
    # A full group has closed before, so an open one has room for the next message.
    group = np.cumsum(place % size == 0) - (0 if held else 1)
    begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    ends = np.append(begins[1:], n) - 1
    counts = ends - begins + 1
    firsts = offsets[begins].copy()
    numbers = number + group[begins]
    if held and group[0] == 0:
        counts[0] += held
        firsts[0] = first
    lasts = offsets[ends]
    if held and group[0] > 0:
        # The first message came after a pause that closes the open group as it was.
        counts, firsts, lasts = np.append(held, counts), np.append(first, firsts), np.append(last, lasts)
        numbers = np.append(number, numbers)
    full = counts == size
    rows = pd.DataFrame(
        {
            "group_no": numbers,
            "first_offset": firsts,
            "last_offset": lasts,
            "messages": counts,
            "closed_by": np.where(full, "count", "idle"),
        }
    )
    following = int(numbers[-1]) + 1
    if full[-1]:
        return rows, None, following
    still = (int(numbers[-1]), int(firsts[-1]), int(lasts[-1]), int(counts[-1]), int(micros[-1]))
    return rows.iloc[:-1], still, following


def grouped_messages(wide: DataFrame, *, size: int, idle: str, delay: str = "1 second") -> DataFrame:
    """(kafka_topic, kafka_partition, group_no, first_offset, last_offset, messages, closed_by) of each group once it closes.

    The messages of a topic partition, in the order of their offsets, make groups of ``size``; a group that got no message for ``idle`` (a
    number and a unit, as in "1 second") closes with fewer. Time is that of the messages: a pause shows when the next message comes, or when
    the stream's watermark (its latest message, less ``delay``) has passed it. Messages that are not later than the watermark of
    their batch are left out, as in any stateful query, so ``delay`` bounds how far partitions may lie apart. State is a row a partition, in the query's checkpoint, so a
    restart goes on with the groups that were open.

    A task holds offsets and times of one partition's messages in a micro-batch; bound the batches at the source.
    """
    spark = wide.sparkSession
    idle_micros = spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {idle})").first()[0]

    def close(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, first, last, held, last_micros = state.get if state.exists else (0, 0, 0, 0, 0)
        if state.hasTimedOut:
            rows = pd.DataFrame(
                {"group_no": [number], "first_offset": [first], "last_offset": [last], "messages": [held], "closed_by": ["idle"]}
            )
            state.update((number + 1, 0, 0, 0, last_micros))
        else:
            batch = pd.concat(list(frames)).sort_values("kafka_offset", kind="stable")
            offsets, micros = batch["kafka_offset"].to_numpy(), batch["micros"].to_numpy()
            given = (number, first, last, held, last_micros)
            rows, still, following = closed_groups(given, offsets, micros, size, idle_micros)
            state.update(still or (following, 0, 0, 0, int(micros[-1])))
            if still:
                state.setTimeoutTimestamp((int(micros[-1]) + idle_micros) // 1000)
        rows.insert(0, "kafka_topic", key[0])
        rows.insert(1, "kafka_partition", key[1])
        yield rows

    timed = wide.select("kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp").withWatermark("kafka_timestamp", delay)
    timed = timed.withColumn("micros", F.unix_micros("kafka_timestamp"))
    return timed.groupBy("kafka_topic", "kafka_partition").applyInPandasWithState(
        close, CLOSED, _OPEN, "append", GroupStateTimeout.EventTimeTimeout
    )
