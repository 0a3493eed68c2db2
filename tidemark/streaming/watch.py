"""Watched streams: progress and failures per table, and a failed stream restarted alone.

A listener hears of every batch and every end of the streams in a session. ``Watched`` starts one stream per table and, at
each look, starts those again that failed, up to a number of times; the other tables are not touched.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.streaming.upsert import CONTINUOUS_STAGE, Feed, start

# What a table's stream is doing.
RUNNING, FAILED, STOPPED = "running", "failed", "stopped"
_STATUS = "table_name string, state string, batches long, rows long, last_batch long, restarts int, failures int, error string"


@dataclass
class Status:
    """What is known of one table's stream, over all its starts."""

    table_name: str
    state: str = RUNNING
    batches: int = 0
    rows: int = 0
    last_batch: int = -1
    restarts: int = 0
    failures: int = 0
    error: str | None = None


class _Listener(StreamingQueryListener):
    """Books the events of the streams it is told of; events arrive on a thread of Spark's."""

    def __init__(self):
        self.lock = threading.Lock()
        self.of_run: dict[str, Status] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self.lock:
            status = self.of_run.get(str(progress.runId))
            if status and progress.batchId > status.last_batch:
                status.batches += 1
                status.rows += progress.numInputRows
                status.last_batch = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended(str(event.runId), event.exception)

    def ended(self, run: str, error: str | None) -> None:
        """Books the end of a run, once."""
        with self.lock:
            status = self.of_run.pop(run, None)
            if status and error:
                status.state, status.error = FAILED, error.strip().split("\n", 1)[0]
                status.failures += 1
            elif status:
                status.state = STOPPED


class Watched:
    """Streams of several tables. Use it as a context, or call ``stop``."""

    def __init__(self, spark: SparkSession, feeds: Iterable[Feed], interval: str = "180 seconds", most_restarts: int = 3):
        self.spark, self.interval, self.most_restarts = spark, interval, most_restarts
        self.feeds = {f.spec.name: f for f in feeds if f.spec.enabled}
        self.listener = _Listener()
        self.statuses = {name: Status(name) for name in self.feeds}
        self.running: dict[str, StreamingQuery] = {}
        spark.streams.addListener(self.listener)
        for name in self.feeds:
            self._start(name)

    def _start(self, name: str) -> None:
        with self.listener.lock:  # no event of the run is booked before the run is known
            query = start(self.spark, self.feeds[name], CONTINUOUS_STAGE, {"processingTime": self.interval})
            self.listener.of_run[str(query.runId)] = self.statuses[name]
        self.running[name] = query

    def look(self) -> list[str]:
        """Starts failed streams again; returns their tables. One that failed too often stays down.

        A stream whose settings gave it a session of its own is not heard of by the listener, but asked here.
        """
        for query in self.running.values():
            if not query.isActive and query.exception() is not None:
                self.listener.ended(str(query.runId), str(query.exception()))
        with self.listener.lock:
            failed = [s for s in self.statuses.values() if s.state == FAILED and s.restarts < self.most_restarts]
            for status in failed:
                status.state, status.restarts = RUNNING, status.restarts + 1
        for status in failed:
            self._start(status.table_name)
        return [s.table_name for s in failed]

    def status(self) -> DataFrame:
        """One row per table."""
        with self.listener.lock:
            rows = [tuple(vars(s).values()) for s in self.statuses.values()]
        return self.spark.createDataFrame(rows, _STATUS)

    def stop(self) -> None:
        for query in self.running.values():
            query.stop()
        self.spark.streams.removeListener(self.listener)

    def __enter__(self) -> "Watched":
        return self

    def __exit__(self, *_) -> None:
        self.stop()
