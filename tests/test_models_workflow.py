import json

import pytest
from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.fixtures import students
from cohortlake.operators import models, records
from cohortlake.plans import workflow
from cohortlake.plans.context import context
from cohortlake.sources import delimited


@pytest.fixture(scope="module")
def study(spark, sf_dir):
    return context(spark, sf_dir)


def test_comparison_beats_the_majority(study):
    rows = {r["model"]: r for r in study.comparison(*models.MODELS).collect()}
    assert set(rows) == set(models.MODELS)
    for row in rows.values():
        assert all(0.0 <= row[m] <= 1.0 for m in ("accuracy", "precision", "recall", "f1_score"))
        assert row["accuracy"] > 0.6
    assert models.best_model(study.comparison(*models.MODELS)) == "Random Forest"


def test_importances(study, spark):
    forest = study.model("Random Forest")
    table = models.feature_importance(spark, forest, study.training.columns)
    assert table.count() == 38
    assert abs(table.agg(F.sum("importance")).first()[0] - 1.0) < 1e-9
    top = models.top_features(table).collect()
    assert len(top) == 20 and [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)


def test_tree_is_repeatable(study):
    again, _ = models.timed_fit(models.decision_tree(), study.training.train)
    assert again.toDebugString.split("\n", 1)[1] == study.model("Decision Tree").toDebugString.split("\n", 1)[1]


def test_scores_cover_all_labelled_rows(study):
    scored = study.scored("Naive Bayes")
    assert scored.count() == study.labelled.count()
    assert set(schema.DASHBOARD_COLUMNS) <= set(scored.columns)


def test_constant_feature_is_scaled_to_the_middle(spark):
    frame = spark.createDataFrame([(1, 2.0), (1, 4.0), (1, None)], "a int, b double")
    features = models.fit_features(frame, ["a", "b"])
    rows = models.scaled_columns(features, frame, ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [(0.5, 0.0), (0.5, 1.0)]
    ranges = {r["feature"]: (r["low"], r["high"]) for r in models.feature_ranges(frame, ["a", "b"]).collect()}
    assert ranges == {"a": (1.0, 1.0), "b": (2.0, 4.0)}


def test_scale_study_end_to_end(spark, sf_dir, tmp_path):
    headers = {name: header for header, name in schema.HEADERS.items()}
    raw = students(spark, sf_dir).select(
        *(F.col(name).alias(headers[name]) for name in schema.REQUIRED)
    )
    delimited.write_table_csv(raw.limit(400).coalesce(1), str(tmp_path / "raw"), sep=";")
    delimited.normalize_delimited(spark, str(tmp_path / "raw"), str(tmp_path / "csv"))
    work = str(tmp_path / "work")
    table = workflow.scale_study(spark, str(tmp_path / "csv"), work, scales=(2,), rate=500)
    assert {r["model"] for r in table.collect()} == set(models.MODELS)

    stored = spark.read.parquet(f"{work}/scale2/records")
    assert stored.columns == [*schema.PERSISTED, "event_id"]
    assert stored.count() == 800 == stored.select("event_id").distinct().count()
    document = spark.read.text(f"{work}/scale2/results/training_results", wholetext=True).first()[0]
    parsed = json.loads(document)
    assert len(parsed["model_comparison"]) == 4 and len(parsed["feature_importance"]) == 20
    gates = spark.read.csv(f"{work}/scale2/results/system_summary", header=True).collect()
    found = {r["metric"]: r["value"] for r in gates}
    assert float(found["throughput"]) > 0 and found["p50_latency_ms"] is None
    exported = spark.read.csv(f"{work}/scale2/results/dashboard", header=True)
    assert exported.columns == schema.DASHBOARD_COLUMNS
    assert exported.count() == stored.filter("label >= 0").count()
    report = spark.read.csv(f"{work}/scale2/results/throughput_report", header=True).first()
    assert (report["rate_label"], report["is_max"]) == ("500 rec/s", "true")


def test_forest_does_not_depend_on_the_input_partitions(spark, sf_dir):
    rows = records.known_labels(records.enrich(students(spark, sf_dir)))  # not written before
    trees = []
    for partitions in (4, 8):
        training = models.prepare_training(rows.repartition(partitions))
        forest = models.random_forest().setNumTrees(5).fit(training.train)
        trees.append(forest.toDebugString.split("\n", 1)[1])
        training.close()
    assert trees[0] == trees[1]


def test_paced_replay_holds_its_rate(spark, tmp_path):
    import time

    rows = [(f"{k}",) for k in range(30)]
    spark.createDataFrame(rows, "Course string").coalesce(1).write.csv(str(tmp_path / "in"), header=True)
    started = time.time()
    sent = workflow.replay_dataset(
        spark, str(tmp_path / "in"), "parquet", str(tmp_path / "out"), iterations=2, rate=20,
        report_folder=str(tmp_path / "reports"),
    )
    elapsed = time.time() - started
    assert sent == 60 and elapsed >= 2.5
    found = [json.loads(r["value"]) for r in spark.read.parquet(str(tmp_path / "out")).orderBy(F.col("key").cast("int")).collect()]
    assert [r["event_id"] for r in found] == [f"{i}_{k}" for i in (0, 1) for k in range(30)]
    stamps = [r["event_ts_ms"] for r in found]
    assert stamps == sorted(stamps) and stamps[-1] <= time.time() * 1000
    assert 2_500 <= stamps[-1] - stamps[0] <= 1000 * elapsed


def test_training_partitions_follow_from_the_rows():
    parts = models.training_partitions
    assert [parts(n) for n in (0, 1, models.ROWS_AT_LEAST, models.ROWS_AT_LEAST + 1)] == [1, 1, 1, 2]
    assert parts(models.SPREAD * models.ROWS_AT_LEAST) == parts(models.SPREAD * models.ROWS_AT_MOST) == models.SPREAD
    assert parts(10**13) == -(-(10**13) // models.ROWS_AT_MOST)
    sizes = [parts(10**k) for k in range(14)]
    assert sizes == sorted(sizes)


def test_same_forest_and_partitions_from_one_and_from_64_splits(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(models, "ROWS_AT_LEAST", 100)
    rows = records.enrich(students(spark, sf_dir).filter("event_seq < 700"))
    forest = models.random_forest().setNumTrees(5)
    found = []
    for splits in (1, 64):
        training = models.prepare_training(rows.repartition(splits))
        assert training.train.rdd.getNumPartitions() == models.training_partitions(records.known_labels(rows).count()) > 1
        found.append(forest.fit(training.train).toDebugString.split("\n", 1)[1])
        training.close()
    assert found[0] == found[1]
    few = models.prepare_training(rows.filter("event_seq < 90"))
    assert few.train.rdd.getNumPartitions() == 1
    few.close()


def test_tasks_of_a_fit_grow_with_rows_worth_one():
    # 54 million rows: a hundred gradient steps report from each partition, a forest's levels send node statistics.
    parts = [models.training_partitions(n) for n in (900_000, 9_000_000, 54_000_000)]
    assert parts[0] < parts[1] <= parts[2] <= 64
    assert all(n / p >= models.ROWS_AT_LEAST * 0.9 for n, p in zip((900_000, 9_000_000, 54_000_000), parts))


def test_record_plans_are_not_left_to_the_interpreter(spark, sf_dir):
    study = context(spark, sf_dir)
    assert study.labelled.count() > 0
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
