import math
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from cohortlake.operators import latency, metrics


def nearest_rank(values, per_mille):
    ordered = sorted(values)
    return ordered[max(math.ceil(len(ordered) * per_mille / 1000), 1) - 1]


SHARES = {"p0": 0, "p1": 10, "p50": 500, "p99": 990, "p100": 1000}


@pytest.mark.parametrize("top", [10, 5000, 10**7, 2**45, 2**62])
def test_exact_percentiles(spark, top):
    random.seed(top)
    hot = random.randrange(top)
    rows = [(m, hot if random.random() < 0.35 else random.randrange(top)) for m in (0, 1) for _ in range(700)]
    frame = spark.createDataFrame(rows + [(1, None), (9, 5)], "mode int, v bigint").repartition(5)
    found = latency.latency_percentiles(frame, "v", SHARES, "mode", [0, 1]).collect()
    for row in found:
        values = [v for m, v in rows if m == row["mode"]]
        assert row["samples"] == len(values)
        assert {n: row[n] for n in SHARES} == {n: nearest_rank(values, s) for n, s in SHARES.items()}
    assert len(found) == 2


def test_histogram_percentiles_are_bucket_tops(spark):
    values = [1, 2, 3, 5000, 5001, 100000]
    frame = spark.createDataFrame([(v,) for v in values], "latency_us bigint")
    hist = latency.latency_histogram(frame)
    assert {r["bucket_top"]: r["rows"] for r in hist.collect()} == {1: 1, 2: 1, 3: 1, 5003: 2, 100031: 1}
    row = latency.histogram_percentiles(hist, SHARES).first()
    assert (row["p0"], row["p50"], row["p99"]) == (1, 3, 100031)


def test_latency_modes(spark):
    frame = spark.createDataFrame([(True, 10, 5), (False, 20, 7)], "ok boolean, send_us bigint, queue_us bigint")
    assert [r["latency_us"] for r in latency.latency_samples(frame, 1).collect()] == [10]
    assert sorted(r["latency_us"] for r in latency.latency_samples(frame, 0).collect()) == [15, 27]
    both = sorted(map(tuple, latency.latency_samples_by_mode(frame).collect()))
    assert both == [(0, 15), (0, 27), (1, 10)]
    with pytest.raises(ValueError):
        latency.latency_samples(frame, 2)


def test_run_without_length_and_no_stamped_rows(spark):
    frame = spark.createDataFrame([(True, 5)], "ok boolean, ts_us bigint")
    assert tuple(latency.run_summary(frame).first()) == (1, 0, 0.0, 0.0)
    unstamped = spark.createDataFrame([(0,)], "event_ts_ms bigint")
    assert tuple(latency.mean_latency_s(unstamped, 10).first()) == (0, None)
    stamped = spark.createDataFrame([(0,), (1000,), (3000,)], "event_ts_ms bigint")
    assert tuple(latency.mean_latency_s(stamped, 4000).first()) == (2, 2.0)


def test_metrics_equal_the_evaluator(spark):
    random.seed(3)
    rows = [(random.randrange(3), float(random.choice([0, 0, 1]))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "label int, prediction double")
    row = metrics.classification_metrics(frame).first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1_score": "f1"}
    for ours, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=theirs
        )
        assert row[ours] == round(evaluator.evaluate(frame), 4)


def test_metrics_of_several_models(spark):
    frame = spark.createDataFrame([("a", 0, 0.0), ("b", 0, 1.0), ("b", 1, 1.0)], "model string, label int, prediction double")
    found = {r["model"]: r["accuracy"] for r in metrics.classification_metrics(frame, by=["model"]).collect()}
    assert found == {"a": 1.0, "b": 0.5}


def test_percentiles_of_huge_and_negative_values(spark):
    values = [(g, (1 << 60) + k * 1_000_003) for g in ("a", "b") for k in range(300)]
    frame = spark.createDataFrame(values, "g string, v bigint")
    for row in latency.latency_percentiles(frame, "v", {"p50": 500, "p99": 990}, "g").collect():
        mine = sorted(v for g, v in values if g == row["g"])
        assert (row["samples"], row["p50"], row["p99"]) == (300, mine[149], mine[296])
    with pytest.raises(ValueError):
        latency.latency_percentiles(spark.createDataFrame([("a", -1)], "g string, v bigint"), "v", {"p50": 500}, "g")
    assert latency.latency_percentiles(frame.limit(0), "v", {"p50": 500}, "g").count() == 0


def test_stamps_ahead_of_the_clock_measure_nothing(spark):
    frame = spark.createDataFrame([(2_000,), (90_000,)], "event_ts_ms bigint")
    assert latency.mean_latency_s(frame, 1_000).first()["e2e_latency_s"] is None
    assert latency.mean_latency_s(frame, 100_000).first()["e2e_latency_s"] == 54.0


def test_percentiles_where_the_sketch_is_off(spark, monkeypatch):
    """Brackets that miss the rank are counted again over the whole range."""
    monkeypatch.setattr(latency, "SKETCH_K", 8)
    monkeypatch.setattr(latency, "SKETCH_ROOM", 1e-9)
    draw = random.Random(7)
    rows = [(g, draw.randrange(1 << 40)) for g in ("a", "b", "c") for _ in range(5000)]
    frame = spark.createDataFrame([*rows, (None, 1)], "g string, v bigint").repartition(7)
    found = {r["g"]: r for r in latency.latency_percentiles(frame, "v", SHARES, "g").collect()}
    assert set(found) == {"a", "b", "c"}
    for g, row in found.items():
        mine = [v for h, v in rows if h == g]
        assert {n: row[n] for n in SHARES} == {n: nearest_rank(mine, s) for n, s in SHARES.items()}


def test_percentiles_read_their_input_twice(spark, tmp_path):
    """Whatever the values' range is: once for the sketches, once for the brackets."""
    spark.range(1000).selectExpr("id % 2 AS g", "(1L << 61) + id * id * 1000003 AS v").write.parquet(str(tmp_path / "t"))
    from unittest import mock

    scanned = []
    kept = latency.materialize

    def watched(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        scanned.append((name, plan.count("parquet") and str(tmp_path) in str(df.inputFiles())))
        return kept(df, name)

    with mock.patch.object(latency, "materialize", watched):
        result = latency.latency_percentiles(spark.read.parquet(str(tmp_path / "t")), "v", SHARES, "g")
    assert [name for name, reads in scanned if reads] == ["brackets", "inside-brackets"]
    assert str(tmp_path) not in str(result.inputFiles())


def test_bucket_tables_add_up(spark):
    draw = random.Random(3)
    rows = [(draw.randrange(3), draw.randrange(1 << draw.randrange(1, 40))) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "g int, latency_us bigint")
    parts = [latency.bucket_counts(frame.where(f"latency_us % 3 = {k}"), by=["g"]) for k in range(3)]
    whole = latency.latency_histogram(frame, by=["g"])
    merged = latency.running_shares(latency.merge_buckets(parts, ["g"]), ["g"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
