import hashlib
import random

from pyspark.sql import functions as F

from cohortlake.operators import replay, sampling


def test_class_weights_keep_the_divisor_when_a_class_is_missing(spark):
    frame = spark.createDataFrame([(0,)] * 6 + [(2,)] * 2, "label int")
    weights = {r["label"]: r["weight"] for r in sampling.class_weights(frame).collect()}
    assert weights == {0: 8 / 18, 2: 8 / 6}


def test_weights_default_for_other_labels(spark):
    frame = spark.createDataFrame([(0,), (0,), (1,), (-1,), (7,)], "label int")
    weights = sampling.class_weights(frame)
    applied = sampling.apply_weights(frame, weights).collect()
    found = {r["label"]: round(r["class_weight"], 6) for r in applied}
    assert found == {0: round(5 / 6, 6), 1: round(5 / 3, 6), -1: 1.0, 7: 1.0}
    assert len(applied) == 5


def test_split_depends_on_the_key_only(spark):
    frame = spark.range(500).withColumnRenamed("id", "event_seq")
    train, test = sampling.split(frame)
    expected = {k for k in range(500) if int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) % 100 < 80}
    assert {r[0] for r in train.repartition(7).collect()} == expected
    assert train.count() + test.count() == 500
    marked = sampling.with_split(frame.repartition(3))
    assert {r["event_seq"] for r in marked.filter("is_train").collect()} == expected


def test_random_split_covers_everything(spark):
    train, test = sampling.split_random(spark.range(200))
    assert train.union(test).distinct().count() == 200


def test_sequence_with_a_hot_key(spark):
    random.seed(1)
    rows = [(0 if random.random() < 0.4 else random.randrange(50), i) for i in range(3000)]
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "k int, v int").repartition(6)
    numbered = replay.with_sequence(frame, ["k", "v"]).collect()
    assert {r["seq"]: (r["k"], r["v"]) for r in numbered} == dict(enumerate(sorted(rows)))


def test_sequence_descending_and_empty(spark):
    frame = spark.range(10).withColumnRenamed("id", "k")
    numbered = {r["k"]: r["seq"] for r in replay.with_sequence(frame, [F.col("k").desc()]).collect()}
    assert numbered == {k: 9 - k for k in range(10)}
    assert replay.with_sequence(frame.limit(0), ["k"]).count() == 0


def test_sequence_of_copies(spark, monkeypatch):
    monkeypatch.setattr(replay, "_COPIES_PER_CHUNK", 16)
    rows = [(1, "a")] * 500 + [(0, "b")] * 3 + [(2, None)] * 40
    frame = replay.with_sequence(
        spark.createDataFrame(rows, "k int, v string"), ["k"], copies=True
    )
    numbered = frame.collect()
    tasks = frame.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 300
    found = {r["seq"]: (r["k"], r["v"]) for r in numbered}
    assert len(numbered) == len(found) == 543
    assert found == dict(enumerate(sorted(rows, key=lambda r: r[0])))


def test_replicate_keeps_label_shares(spark):
    frame = spark.createDataFrame([(0,), (1,), (1,)], "label int")
    counts = dict(replay.replicate(frame, 4).groupBy("label").count().collect())
    assert counts == {0: 4, 1: 8}
    assert replay.replicate(frame, 0).count() == 0


def test_stamps(spark):
    frame = spark.createDataFrame([(7,)], "seq bigint")
    given = replay.stamp_event(replay.replicate(frame, 2), start_ms=1000, offset_ms=F.col("seq"))
    assert {(r["event_id"], r["event_ts_ms"]) for r in given.collect()} == {("0_7", 1007), ("1_7", 1007)}
    assert replay.stamp_event(replay.replicate(frame, 1)).first()["event_ts_ms"] > 1_600_000_000_000


def test_scale_sweep_equals_separate_replays(spark):
    frame = spark.createDataFrame([(0,), (1,)], "label int")
    swept = replay.scale_sweep(frame, (1, 3))
    for scale in (1, 3):
        one = swept.filter(F.col("scale_factor") == scale).select("label", "iteration")
        assert sorted(map(tuple, one.collect())) == sorted(
            map(tuple, replay.replicate(frame, scale).collect())
        )


def test_split_of_rows_without_a_key_loses_none(spark):
    rows = [(None, k) for k in range(200)] + [("", k) for k in range(200)] + [(str(k), k) for k in range(200)]
    frame = spark.createDataFrame(rows, "key string, v int")
    train, test = sampling.split(frame, "key")
    assert train.unionByName(test).exceptAll(frame).isEmpty() and train.count() + test.count() == 600
    for part in (train, test):
        kinds = {r["key"] if not r["key"] else "k" for r in part.select("key").distinct().collect()}
        assert kinds == {None, "", "k"}  # rows without a key are not all on one side


def test_file_sequence_needs_no_shuffle_of_rows(spark, tmp_path):
    from cohortlake.sources import delimited

    lines = spark.range(1000).selectExpr("id", "concat('v', id) as v").repartitionByRange(4, "id").sortWithinPartitions("id")
    delimited.write_table_csv(lines, str(tmp_path / "lines"))
    read = delimited.with_places(delimited.read_cells(spark, str(tmp_path / "lines")))
    numbered = replay.with_file_sequence(read)
    assert all(int(r["id"]) == r["seq"] for r in numbered.collect()) and numbered.columns == ["id", "v", "seq"]
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    assert replay.with_file_sequence(read.limit(0)).count() == 0


def test_sent_rows_carry_no_future_stamp(spark):
    import time

    import pytest

    frame = spark.range(5).selectExpr("id as seq", "0 as iteration")
    stamped = replay.stamp_event(frame).collect()
    assert all(0 <= int(time.time() * 1000) - r["event_ts_ms"] < 60_000 for r in stamped)
    with pytest.raises(ValueError):
        replay.stamp_event(frame, offset_ms=F.col("seq") * 1000)
