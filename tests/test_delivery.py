"""Deliveries that fail at every point and still count once."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cohortlake.operators.replay import with_sequence
from cohortlake.streaming import reports
from cohortlake.streaming.delivery import CommitLog, CommittedFolder
from cohortlake.streaming.replay import paced_replay, replay_into, replay_units

ROWS, ROUNDS = 40, 2
EXPECTED = sorted(f"{i}_{s}" for i in range(ROUNDS) for s in range(ROWS))


@pytest.fixture
def numbered(spark):
    return with_sequence(spark.range(ROWS).selectExpr("concat('t', id) AS target", "id AS key"), ["key"]).cache()


def restarted(start):
    """Start again after each error of the query; how often that was."""
    for failures in range(9):
        try:
            start()
            return failures
        except StreamingQueryException:
            pass
    raise AssertionError("never done")


class Failing(CommittedFolder):
    """Raises once at each of the named moments of the first batches."""

    def __init__(self, spark, path, moments):
        super().__init__(spark, path)
        self.moments = list(moments)

    def _fail(self, moment):
        if self.moments and self.moments[0] == moment:
            self.moments.pop(0)
            raise OSError(f"lost {moment}")

    def write(self, unit, rows, **options):
        if self.log.has(unit):
            return False
        self._fail("before")
        if self.moments[:1] == ["halfway"]:
            self.stage(unit, rows.where(F.col("seq") % 2 == 0))
            self._fail("halfway")
        attempt = self.stage(unit, rows)
        self._fail("written")
        done = self.commit(unit, attempt)
        self._fail("committed")
        return done


@pytest.mark.parametrize("moments", [["written"], ["before", "halfway", "written", "committed"]])
def test_every_record_counts_once_wherever_a_delivery_fails(spark, numbered, tmp_path, moments):
    folder = Failing(spark, str(tmp_path / "out"), moments)
    mark = str(tmp_path / "mark")
    failures = restarted(lambda: replay_units(numbered, ROWS, 60, ROUNDS, folder.write, mark))
    assert failures == len(moments) and not folder.moments
    rows = folder.read().collect()
    assert sorted(r["event_id"] for r in rows) == EXPECTED
    assert all(r["target"] == f"t{r['seq']}" for r in rows)
    staged = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert staged.count() > len(EXPECTED)
    assert folder.sweep() >= 1 and folder.sweep() == 0
    assert spark.read.parquet(str(tmp_path / "out" / "data")).count() == len(EXPECTED)


def test_replay_into_a_folder_without_failures(spark, numbered, tmp_path):
    folder = CommittedFolder(spark, str(tmp_path / "out"))
    assert replay_into(folder, numbered, ROWS, 200, ROUNDS, str(tmp_path / "mark")) == ROWS * ROUNDS
    assert sorted(r["event_id"] for r in folder.read().collect()) == EXPECTED
    # a later run with the same checkpoint has nothing left to send
    replay_into(folder, numbered, ROWS, 200, ROUNDS, str(tmp_path / "mark"))
    assert folder.read().count() == len(EXPECTED)


def test_log_keeps_a_delivered_batch_from_being_sent_again(spark, numbered, tmp_path):
    log, sent, broken = CommitLog(spark, str(tmp_path / "log")), [], []

    def deliver(due):
        sent.extend(r["event_id"] for r in due.collect())

    class Late(CommitLog):
        """Dies after the first record is written, before the batch is done."""

        def record(self, unit, note=""):
            done = super().record(unit, note)
            if not broken:
                broken.append(unit)
                raise OSError("lost")
            return done

    late = Late(spark, log.path)
    mark = str(tmp_path / "mark")
    assert restarted(lambda: paced_replay(numbered, ROWS, 100, ROUNDS, deliver, mark, log=late)) == 1
    assert sorted(sent) == EXPECTED and broken
    assert {r["unit"] for r in log.records().collect()} >= set(broken)


def test_commit_log_records_once_and_refuses_odd_names(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.records().count() == 0 and not log.has("a")
    assert log.record("a", "note ä\nmore") and not log.record("a", "other") and log.record("b")
    assert sorted(map(tuple, log.records().collect())) == [("a", "note ä\nmore"), ("b", "")]
    for name in ("", "x/y", ".hidden", "_x"):
        with pytest.raises(ValueError):
            log.record(name)


def test_folder_shows_what_is_committed(spark, tmp_path):
    folder = CommittedFolder(spark, str(tmp_path / "out"))
    kind = spark.range(0).schema
    assert folder.read(kind).count() == 0 and folder.sweep() == 0
    with pytest.raises(FileNotFoundError):
        folder.read()
    lost = folder.stage("1", spark.range(5))
    assert folder.read(kind).count() == 0
    assert folder.write("1", spark.range(3)) and not folder.write("1", spark.range(9))
    assert not folder.commit("1", lost)
    assert folder.write("2", spark.range(10, 12))
    assert sorted(map(tuple, folder.read().select("id", "unit").collect())) == [(0, "1"), (1, "1"), (2, "1"), (10, "2"), (11, "2")]
    assert folder.read_unit("2").count() == 2
    with pytest.raises(FileNotFoundError):
        folder.read_unit("3")


def fed(spark, inbox, rows, kind, start):
    """One arrival of rows, drained."""
    spark.createDataFrame(rows, kind).write.mode("append").parquet(inbox)
    start(spark.readStream.schema(kind).parquet(inbox)).awaitTermination()


def test_latest_rows_whatever_order_they_come_in(spark, tmp_path):
    kind, folder = "k string, ts bigint, name string, v int", CommittedFolder(spark, str(tmp_path / "out"))

    def arrive(*rows):
        fed(spark, str(tmp_path / "in"), list(rows), kind, lambda stream: reports.stream_latest(
            stream, folder, str(tmp_path / "mark"), ["k"], "ts", "name"))
        return {r["k"]: (r["ts"], r["name"], r["v"]) for r in reports.latest_rows(folder, ["k"]).collect()}

    assert arrive(("a", 5, "x", 1), ("a", 7, "z", 2), ("b", 1, "x", 3), ("c", None, "x", 9)) == {
        "a": (7, "z", 2), "b": (1, "x", 3), "c": (None, "x", 9),
    }
    assert arrive(("a", 7, "y", 4), ("c", -(1 << 63), "z", 5)) == {"a": (7, "y", 4), "b": (1, "x", 3), "c": (-(1 << 63), "z", 5)}
    assert arrive(("a", 6, "a", 6), (None, 1, "n", 7)) == {
        "a": (7, "y", 4), "b": (1, "x", 3), "c": (-(1 << 63), "z", 5), None: (1, "n", 7),
    }


def test_delay_windows_close_and_count_what_is_late(spark, tmp_path):
    kind, folder = "event_ts_ms bigint, at bigint", CommittedFolder(spark, str(tmp_path / "out"))

    def arrive(*rows):
        fed(spark, str(tmp_path / "in"), list(rows), kind, lambda stream: reports.stream_delay(
            stream, folder, str(tmp_path / "mark"), F.col("at"), 1000, 2000))
        return {r["window_start_ms"]: tuple(r)[1:] for r in reports.delay_windows(folder).collect()}

    assert arrive((1100, 1200), (1900, 2200), (0, 5), (2500, 2600)) == {1000: (2, 0.2, 0), 2000: (1, 0.1, 0)}
    # the first window is still open, and in the same batch nothing is late
    assert arrive((1000, 1500), (9000, 9001)) == {1000: (3, 0.3, 0), 2000: (1, 0.1, 0), 9000: (1, 0.001, 0)}
    assert arrive((1500, 99000), (7000, 7500), (5999, 9000)) == {
        1000: (3, 0.3, 1), 2000: (1, 0.1, 0), 9000: (1, 0.001, 0), 7000: (1, 0.5, 0), 5000: (0, None, 1),
    }


def test_a_repeated_batch_changes_no_report(spark, tmp_path):
    """The query dies after the batch's unit is committed; the batch comes again."""
    kind, inbox, mark = "event_ts_ms bigint, at bigint", str(tmp_path / "in"), str(tmp_path / "mark")
    folder = Failing(spark, str(tmp_path / "out"), ["written", "committed"])
    spark.createDataFrame([(1100, 1200), (1300, 1300)], kind).write.parquet(inbox)

    def start():
        stream = spark.readStream.schema(kind).parquet(inbox)
        reports.stream_delay(stream.withColumn("seq", F.lit(0)), folder, mark, F.col("at"), 1000, 2000).awaitTermination()

    assert restarted(start) == 2
    assert [tuple(r) for r in reports.delay_windows(folder).collect()] == [(1000, 2, 0.05, 0)]
