"""Counts of an ingest that outlive its driver: taken from the listener, stored per batch beside the checkpoint."""

from __future__ import annotations

import json
import queue
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cohortlake.session import file_system, path_exists
from cohortlake.streaming.delivery import CommitLog
from cohortlake.streaming.ingest import IngestCounters, batch_counts

#: Records kept behind the newest one.
KEPT_RECORDS = 100


@dataclass
class StoredCounts:
    """``total`` of all batches up to ``last``; ``missing`` are batches that finished without being counted."""

    last: int = -1
    total: IngestCounters = field(default_factory=IngestCounters)
    missing: list[list[int]] = field(default_factory=list)


class CountLog:
    """The counts after each batch, one small file per batch, in ``ingest-counts`` of the checkpoint.

    Every record holds the sum up to its batch, so the newest one is enough and old ones are removed.
    A batch that is run again under its number, or reported twice, counts once. A batch whose driver
    died between the batch's commit and its report is not guessed: its number is listed as missing,
    as a range ``[first, last]``.
    """

    def __init__(self, spark: SparkSession, checkpoint: str) -> None:
        self.spark = spark
        self.log = CommitLog(spark, f"{checkpoint.rstrip('/')}/ingest-counts")
        self.state = self._newest()

    def _names(self) -> list[str]:
        if not path_exists(self.spark, self.log.path):
            return []
        fs, folder = file_system(self.spark, self.log.path)
        names = (status.getPath().getName() for status in fs.listStatus(folder))
        return sorted(name for name in names if not name.startswith((".", "_")))

    def _newest(self) -> StoredCounts:
        names = self._names()
        if not names:
            return StoredCounts()
        note = json.loads(self.log.records().where(f"unit = '{names[-1]}'").first()["note"])
        return StoredCounts(note["last"], IngestCounters(*note["total"]), note["missing"])

    def report(self, progress) -> bool:
        """Take in a query's progress; one without a finished batch names the batch that comes next."""
        if "addBatch" not in progress["durationMs"]:
            return False
        return self.take(progress["batchId"], batch_counts(progress))

    def take(self, batch: int, counts: tuple[int, int, int, int] | None) -> bool:
        """Add a finished batch; ``None`` for one without messages. Whether it brought any."""
        if batch <= self.state.last:
            return False
        gap = [[self.state.last + 1, batch - 1]] if batch > self.state.last + 1 else []
        total = self.state.total
        if counts is not None:
            total = IngestCounters(total.batches + 1, *(a + b for a, b in zip(total.parts, counts)))
        state = StoredCounts(batch, total, self.state.missing + gap)
        note = {"last": batch, "total": [total.batches, *total.parts], "missing": state.missing}
        if not self.log.record(f"{batch:012d}", json.dumps(note)):
            raise RuntimeError(f"another query counts in {self.log.path}")
        self.state = state
        for name in self._names()[: -KEPT_RECORDS - 1]:
            fs, old = file_system(self.spark, f"{self.log.path}/{name}")
            fs.delete(old, False)
        return counts is not None


class _Events(StreamingQueryListener):
    """Hands the events of all queries to the thread that waits for one of them."""

    def __init__(self) -> None:
        self.queue: queue.SimpleQueue = queue.SimpleQueue()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.queue.put(("progress", event.progress.runId, event.progress))

    def onQueryIdle(self, event) -> None:
        self.queue.put(("idle", event.runId, None))

    def onQueryTerminated(self, event) -> None:
        self.queue.put(("ended", event.runId, None))


def drain_counted(
    spark: SparkSession,
    start: Callable[[], StreamingQuery],
    checkpoint: str,
    idle_s: float | None = None,
    timeout_s: float | None = None,
    poll_s: float = 1.0,
) -> StoredCounts:
    """Run the query that ``start`` starts to its end and return the counts of all runs of its checkpoint.

    Batches are counted by the events that Spark reports, not by asking for the progress it remembers.
    With ``idle_s`` a query that runs on is stopped by the first idle event that long after its last
    message; Spark reports idleness every ``spark.sql.streaming.noDataProgressEventInterval`` ms. An
    error of the query is raised after what it finished before is counted.
    """
    log, events = CountLog(spark, checkpoint), _Events()
    spark.streams.addListener(events)
    try:
        query = start()
        begun = last_news = time.monotonic()
        ended_at = None
        while True:
            try:
                kind, run, progress = events.queue.get(timeout=poll_s)
            except queue.Empty:
                kind, run, progress = None, None, None
            now = time.monotonic()
            if kind is not None and str(run) != str(query.runId):
                continue
            if kind == "ended":
                break
            if kind == "progress" and log.report(progress):
                last_news = now
            if kind == "idle" and idle_s is not None and now - last_news > idle_s:
                query.stop()
            if timeout_s is not None and now - begun > timeout_s and query.isActive:
                query.stop()
                raise TimeoutError(f"the ingest did not end within {timeout_s} s")
            if not query.isActive:  # a full event bus may drop the last event
                ended_at = ended_at or now
                if now - ended_at > 30:
                    break
        for progress in query.recentProgress:
            log.report(progress)
        if query.exception() is not None:
            raise query.exception()
        return log.state
    finally:
        spark.streams.removeListener(events)
