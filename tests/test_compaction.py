import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortlake.sources import batches, compaction
from cohortlake.streaming.delivery import CommitLog

FILES = 40


def table(spark, path, first=0, files=FILES, mode="error"):
    rows = spark.range(first, first + files * 10, 1, files).select("id", F.expr("'g' || id % 7").alias("target"))
    rows.write.mode(mode).parquet(path)


def ids(spark, path):
    return sorted(row["id"] for row in batches.scan_parquet(spark, path).collect())


def files(spark, path):
    return compaction.live_files(spark, path)


@pytest.mark.parametrize("name", ["plain", "with space", "per%20cent"])
def test_same_rows_before_during_and_after(spark, tmp_path, monkeypatch, name):
    path = str(tmp_path / name)
    table(spark, path)
    seen = []
    commit = CommitLog.record

    def watched(log, unit, note=""):
        seen.append(ids(spark, path))  # merged rows are written, and do not count yet
        return commit(log, unit, note)

    monkeypatch.setattr(CommitLog, "record", watched)
    assert compaction.compact(spark, path) == FILES
    assert seen == [list(range(400))] and ids(spark, path) == list(range(400))
    assert list(files(spark, path).values()) == [True]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(400))  # readers that know nothing of it
    assert compaction.compact(spark, path) == 0
    assert compaction.sweep(spark, path) == FILES and ids(spark, path) == list(range(400))
    assert batches.rows_per_file(spark, path).agg(F.sum("rows")).first()[0] == 400


def test_repeated_merges_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for turn in range(4):
        table(spark, path, turn * 400, mode="append")
        compaction.compact(spark, path)
    assert ids(spark, path) == list(range(1600)) and len(files(spark, path)) == 1
    assert compaction.sweep(spark, path) == 4 * FILES + 3 and ids(spark, path) == list(range(1600))


def test_merges_take_some_files_at_a_time_and_keep_to_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path)
    size = max(file.stat().st_size for file in (tmp_path / "t").glob("*.parquet"))
    compaction.compact(spark, path, target_bytes=4 * size, files_at_once=12)
    assert ids(spark, path) == list(range(400)) and len(files(spark, path)) <= FILES // 2
    big = str(tmp_path / "big")
    table(spark, big)
    assert compaction.compact(spark, big, target_bytes=1) == 0  # every file is over half of the target
    with pytest.raises(ValueError):
        compaction.compact(spark, big, target_bytes=0)


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table(spark, path)
    with monkeypatch.context() as broken:
        broken.setattr(CommitLog, "record", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            compaction.compact(spark, path)
    assert ids(spark, path) == list(range(400)) and not any(files(spark, path).values())
    assert compaction.compact(spark, path) == FILES and ids(spark, path) == list(range(400))


def test_of_two_runs_at_once_one_counts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table(spark, path)
    both, errors = threading.Barrier(2, timeout=90), []
    record = CommitLog.record

    def together(log, unit, note=""):
        if unit == "00000000":
            both.wait()
        return record(log, unit, note)

    monkeypatch.setattr(CommitLog, "record", together)

    def run():
        try:
            compaction.compact(spark, path)
        except RuntimeError as error:
            errors.append(error)

    threads = [threading.Thread(target=run) for _ in range(2)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(errors) == 1 and ids(spark, path) == list(range(400))


def test_files_of_different_columns_and_unsigned_times(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    pq.write_table(pa.table({"id": [1], "event_ts_ms": pa.array([5], pa.uint64())}), path / "a.parquet")
    pq.write_table(pa.table({"id": [2], "event_ts_ms": pa.array([6], pa.uint64()), "note": ["x"]}), path / "b.parquet")
    pq.write_table(pa.table({"id": pa.array([], pa.int64()), "event_ts_ms": pa.array([], pa.uint64())}), path / "c.parquet")
    assert compaction.compact(spark, str(path)) == 3
    pq.write_table(pa.table({"id": [3], "event_ts_ms": pa.array([7], pa.uint64())}), path / "d.parquet")
    found = batches.scan_parquet(spark, str(path)).select("id", "event_ts_ms", "note")
    assert dict(found.dtypes)["event_ts_ms"] == "bigint"
    assert sorted(tuple(row) for row in found.collect()) == [(1, 5, None), (2, 6, "x"), (3, 7, None)]
