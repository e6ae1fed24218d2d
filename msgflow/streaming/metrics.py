"""Counters and timings of running queries."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql.streaming import StreamingQueryListener


class CounterListener(StreamingQueryListener):
    """Adds up the observed counts and the durations of all batches, per query run.

    Register with ``spark.streams.addListener``. ``counts[run_id][counter][column]`` and
    ``millis[run_id][phase]`` hold the sums; ``finished`` holds the runs that have ended.
    """

    def __init__(self) -> None:
        self.counts: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
        self.millis: dict = defaultdict(lambda: defaultdict(int))
        self.finished: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = str(progress.runId)
        with self._changed:
            for counter, row in progress.observedMetrics.items():
                for column, value in row.asDict().items():
                    self.counts[run][counter][column] += value or 0
            for phase, millis in progress.durationMs.items():
                self.millis[run][phase] += millis

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self.finished.add(str(event.runId))
            self._changed.notify_all()

    def wait_for(self, run_id, timeout: float | None = None) -> dict:
        """The counts of a run once its last event has arrived, however long that takes unless ``timeout`` is given."""
        run = str(run_id)
        with self._changed:
            if not self._changed.wait_for(lambda: run in self.finished, timeout):
                raise TimeoutError(f"no end event for query run {run}")
            return {counter: dict(columns) for counter, columns in self.counts[run].items()}
