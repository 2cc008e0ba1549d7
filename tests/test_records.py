from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.fixtures import students
from cohortlake.operators import records


def test_enriched_shape(spark, sf_dir):
    stored = records.project_record(records.enrich(students(spark, sf_dir)), ["event_seq"])
    assert stored.columns == [*schema.PERSISTED, "event_seq"]
    assert len(schema.PERSISTED) == 43 and len(schema.FEATURES) == 38
    assert dict(stored.dtypes)["event_ts_ms"] == "bigint"


def test_feature_list_follows_the_frame(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "gdp int, other int, gender int")
    assert records.resolve_features(frame) == ["gender", "gdp"]


def test_validity(spark):
    nan = float("nan")
    rows = [(1, 17, 0.0, 0.0), (2, 16, 1.0, 1.0), (3, 70, -0.1, 1.0), (4, 20, 1.0, nan), (5, 30, None, 1.0)]
    frame = spark.createDataFrame(
        rows,
        "k int, age_at_enrollment int, curricular_units_1st_sem_grade double, "
        "curricular_units_2nd_sem_grade double",
    )
    assert [r["k"] for r in records.valid_records(frame).collect()] == [1]
    report = {r["rule"]: r["failed_rows"] for r in records.validity_report(frame).collect()}
    assert report == {"age_in_range": 1, "grade_1st_sem": 2, "grade_2nd_sem": 1}


def test_drop_invalid_features_equals_the_assembler(spark):
    from cohortlake.operators.models import assemble

    rows = [(1, 1.0), (2, None), (None, 1.0), (4, float("nan")), (5, float("inf"))]
    frame = spark.createDataFrame(rows, "a int, b double")
    kept = records.drop_invalid_features(frame, ["a", "b"]).collect()
    assert kept == assemble(["a", "b"]).transform(frame).drop("features_raw").collect()


def test_null_counts(spark):
    frame = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    counts = {r["column"]: r["null_cells"] for r in records.null_counts(frame, ["a", "b"]).collect()}
    assert counts == {"a": 1, "b": 2}


def test_filters(spark):
    frame = spark.createDataFrame([(-1, 0), (0, 5), (None, None)], "label int, event_ts_ms bigint")
    assert records.known_labels(frame).count() == 1
    assert records.has_event_time(frame).count() == 1
    assert records.select_columns(frame, ["label"]).columns == ["label"]
    spaced = records.trim_headers(frame.select(F.col("label").alias(" GDP\t")))
    assert records.rename_columns(spaced).columns == ["gdp"]
