"""Continuous ingest: messages to enriched Parquet, with the same functions as the batch path."""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlake import schema
from cohortlake.operators import records
from cohortlake.sources import messages

OBSERVED = "ingest"


def once_per_event(records_: DataFrame, within: str) -> DataFrame:
    """Records without those that repeat an ``event_id`` within so much event time.

    A stream keeps the ids of that time in its state, spread over the cluster by id; the watermark
    follows the greatest ``event_ts_ms`` at that distance, and a record from before it, whose copies
    are forgotten, is dropped as late (``IngestCounters.late``). Choose the time so that no record
    comes that late. Records without an id or a time cannot be told apart and all stay.
    """
    named = (F.col("event_id") != "") & (F.col("event_ts_ms") > 0)
    keyed = records_.withColumns({
        "_at": F.when(named, F.timestamp_millis("event_ts_ms")),
        "_key": F.when(named, F.concat(F.lit("id "), "event_id")).otherwise(F.concat(F.lit("row "), F.uuid())),
    })
    if not keyed.isStreaming:
        return keyed.dropDuplicates(["_key"]).drop("_at", "_key")
    return keyed.withWatermark("_at", within).dropDuplicatesWithinWatermark(["_key"]).drop("_at", "_key")


def ingest(stream: DataFrame, extra: tuple[str, ...] = (), once_within: str | None = None) -> DataFrame:
    """Messages to persisted records; works on a stream and on a batch alike.

    Malformed messages are dropped and counted in the metrics observed under ``ingest``. Name
    ``event_id`` in ``extra`` to store it behind the fixed columns. With ``once_within``, a time such
    as ``"1 hour"``, a message sent again is stored once (see ``once_per_event``).
    """
    decoded = messages.decode_json(stream)
    counted = decoded.observe(
        OBSERVED,
        F.count("*").alias("received"),
        F.count_if("valid").alias("kept"),
    )
    good = counted.filter("valid").select("record.*")
    if once_within is not None:
        good = once_per_event(good, once_within)
    return records.project_record(records.enrich(good), extra)


def stream_ingest(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    rows_per_file: int = schema.FILE_ROWS,
    extra: tuple[str, ...] = (),
    until_drained: bool = True,
    interval: str = "10 seconds",
    once_within: str | None = None,
) -> StreamingQuery:
    """Start the ingest. It resumes where the run with the same checkpoint ended.

    ``until_drained`` processes what is there and stops; otherwise it runs at the given interval.
    How much one batch takes is set on the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
    ``once_within`` is a property of the checkpoint: start all its runs with or without it.
    """
    writer = (
        ingest(stream, extra, once_within)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
    )
    trigger = {"availableNow": True} if until_drained else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def stream_rejects(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the messages the ingest drops, as key and value, in a table of their own."""
    _, rejected = messages.decode_strict(stream)
    writer = rejected.writeStream.format("parquet").outputMode("append").option("path", out)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_with_rejects(
    stream: DataFrame,
    out: str,
    rejects: str,
    checkpoint: str,
    rows_per_file: int = schema.FILE_ROWS,
    extra: tuple[str, ...] = (),
) -> StreamingQuery:
    """Ingest good messages and keep the others, as key and value, from one decoding of each batch.

    Every batch has a folder of its own in both tables (column ``batch``), which a repeated batch
    overwrites, so a restart neither loses nor repeats rows.
    """

    def store(batch: DataFrame, number: int) -> None:
        decoded = messages.decode_json(batch).persist(StorageLevel.DISK_ONLY)
        try:
            good = decoded.filter("valid").select("record.*")
            kept = records.project_record(records.enrich(good), extra)
            kept.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{out}/batch={number}")
            bad = decoded.filter("not valid").select(*batch.columns)
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        finally:
            decoded.unpersist()

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


#: Words of errors that another try cannot mend: the plan, the data's layout or the checkpoint is wrong.
LASTING = ("AnalysisException", "ParseException", "StateSchema", "UnsupportedOperation", "FileFormat", "ClassNotFound")


def may_pass(error: StreamingQueryException) -> bool:
    """Whether an error of a query is of the kind that goes away, as those of a source or a lost node do."""
    return not any(word in str(error) for word in LASTING)


def run_until_drained(
    start: Callable[[], StreamingQuery],
    tries: int = 3,
    pause_s: float = 1.0,
    longest_s: float = 60.0,
    passing: Callable[[StreamingQueryException], bool] = may_pass,
    sleep: Callable[[float], None] = time.sleep,
    **waiting,
) -> IngestCounters:
    """Drain the query that ``start`` starts; after an error that may pass go on from the checkpoint.

    Before each further try it waits, twice as long as before it, ``longest_s`` at most; a try that took
    in new messages starts the count and the waits anew. ``waiting`` goes to ``drain``, so a query that
    runs on is looked after as well. The counts cover all tries: a batch that a failed try finished is
    counted once. A lasting error, and the error of the last of ``tries``, is raised.
    """
    if tries < 1:
        raise ValueError("at least one try is needed")
    seen, failures = _Progress(), 0
    while True:
        before = seen.batches
        try:
            return drain(start(), seen=seen, **waiting)
        except StreamingQueryException as error:
            failures = 1 if seen.batches > before else failures + 1
            if failures >= tries or not passing(error):
                raise
            wait = min(longest_s, pause_s * 2 ** (failures - 1))
            warnings.warn(f"the ingest is started again in {wait:g} s: {error}", stacklevel=2)
            sleep(wait)


@dataclass
class IngestCounters:
    """``kept`` are the well-formed messages; of these ``repeated`` and ``late`` ones are not stored."""

    batches: int = 0
    received: int = 0
    kept: int = 0
    repeated: int = 0
    late: int = 0

    @property
    def dropped(self) -> int:
        return self.received - self.kept

    @property
    def stored(self) -> int:
        return self.kept - self.repeated - self.late

    @property
    def parts(self) -> tuple[int, int, int, int]:
        return self.received, self.kept, self.repeated, self.late


def batch_counts(progress) -> tuple[int, int, int, int] | None:
    """Received, kept, repeated and late messages of a batch's progress; none if it had no messages."""
    observed = progress["observedMetrics"].get(OBSERVED)
    if observed is None or progress["numInputRows"] == 0:
        return None
    states = progress["stateOperators"]
    repeated = sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for s in states)
    late = sum(s["numRowsDroppedByWatermark"] for s in states)
    return observed["received"], observed["kept"], repeated, late


class _Progress:
    """Adds up a query's batches; polled more often than the query forgets its progress."""

    def __init__(self) -> None:
        self._seen: dict[int, tuple[int, int, int, int]] = {}

    @property
    def batches(self) -> int:
        return len(self._seen)

    def poll(self, query: StreamingQuery) -> bool:
        """Take in new batches; whether any of them brought messages."""
        news = False
        for progress in query.recentProgress:
            counts = batch_counts(progress)
            if counts is not None and progress["batchId"] not in self._seen:
                news = True
                self._seen[progress["batchId"]] = counts
        return news

    def counters(self) -> IngestCounters:
        return IngestCounters(len(self._seen), *(sum(n) for n in zip(*self._seen.values())))


def drain(
    query: StreamingQuery,
    idle_s: float | None = None,
    timeout_s: float | None = None,
    poll_s: float = 0.2,
    seen: _Progress | None = None,
) -> IngestCounters:
    """Wait until the query has stopped and return what it took in, with what ``seen`` holds already.

    A query that ran until drained ends by itself. For one that runs on, ``idle_s`` stops it after
    that long without a message. There is no time limit unless ``timeout_s`` sets one. An error of
    the query is raised here.
    """
    seen = _Progress() if seen is None else seen
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    last_news = time.monotonic()
    try:
        while not query.awaitTermination(poll_s):
            now = time.monotonic()
            if seen.poll(query):
                last_news = now
            if deadline is not None and now > deadline:
                query.stop()
                raise TimeoutError(f"the ingest did not end within {timeout_s} s")
            if idle_s is not None and now - last_news > idle_s and not query.status["isTriggerActive"]:
                query.stop()
    finally:
        seen.poll(query)  # also what a query finished before its error
    return seen.counters()


def ingest_counters(query: StreamingQuery) -> IngestCounters:
    """Messages received and kept in the batches the query still remembers."""
    seen = _Progress()
    seen.poll(query)
    return seen.counters()
