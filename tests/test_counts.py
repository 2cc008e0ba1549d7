import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_sources_streaming import text

from cohortlake.sources import messages
from cohortlake.streaming import counts, ingest


@pytest.fixture
def table(spark, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def arrive(*values):
        rows = [(str(i), value) for i, value in enumerate(values)]
        spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("append").parquet(inbox)

    def start(**options):
        stream = messages.read_messages(spark, "parquet", inbox, maxFilesPerTrigger=1)
        return ingest.stream_ingest(stream, out, mark, **options)

    return arrive, start, mark


def test_counts_go_on_after_a_restart(spark, table):
    arrive, start, mark = table
    arrive(text(), "not json")
    arrive(text())
    first = counts.drain_counted(spark, start, mark)
    assert (first.total.batches, first.total.received, first.total.kept) == (2, 3, 2)
    arrive("null", text(), text())
    second = counts.drain_counted(spark, start, mark)
    assert (second.total.batches, second.total.received, second.total.kept) == (3, 6, 4)
    assert second.total.dropped == 2 and second.missing == []
    assert counts.CountLog(spark, mark).state == second
    assert counts.drain_counted(spark, start, mark) == second  # nothing new


def test_a_run_nobody_counted_is_reported_as_missing(spark, table):
    arrive, start, mark = table
    arrive(text())
    counts.drain_counted(spark, start, mark)
    arrive(text(), text())
    start().awaitTermination()
    arrive(text())
    found = counts.drain_counted(spark, start, mark)
    assert found.total.received == 2 and found.missing == [[1, 1]]


def test_a_batch_counts_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(counts, "KEPT_RECORDS", 3)
    log = counts.CountLog(spark, str(tmp_path))
    assert log.take(0, (5, 4, 1, 0)) and not log.take(0, (5, 4, 1, 0)) and not log.take(1, None)
    for batch in range(2, 9):
        log.take(batch, (1, 1, 0, 0))
    again = counts.CountLog(spark, str(tmp_path))
    assert again.state == log.state and again.state.total == ingest.IngestCounters(8, 12, 11, 1, 0)
    assert again._names() == [f"{n:012d}" for n in (5, 6, 7, 8)]
    stale = counts.CountLog(spark, str(tmp_path))
    again.take(9, None)
    with pytest.raises(RuntimeError):
        stale.take(9, (1, 1, 0, 0))


def test_idle_queries_stop_by_event_and_errors_come_out(spark, table, tmp_path):
    arrive, start, mark = table
    arrive(text())
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "200ms")
    try:
        found = counts.drain_counted(
            spark, lambda: start(until_drained=False, interval="100 milliseconds"), mark, idle_s=1.0, timeout_s=90
        )
    finally:
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
    assert found.total.received == 1
    with pytest.raises(TimeoutError):
        counts.drain_counted(spark, lambda: start(until_drained=False, interval="1 second"), mark, timeout_s=2)

    def broken():
        stream = messages.read_messages(spark, "parquet", str(tmp_path / "in"))
        bad = stream.withColumn("value", F.raise_error(F.lit("no such luck")).cast("string"))
        return ingest.stream_ingest(bad, str(tmp_path / "out2"), str(tmp_path / "mark2"))

    with pytest.raises(StreamingQueryException):
        counts.drain_counted(spark, broken, str(tmp_path / "mark2"))
