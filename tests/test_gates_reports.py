import os

import pytest

from cohortlake import schema
from cohortlake.operators import gates, reports
from cohortlake.sources import results


def values(spark, **measured):
    return spark.createDataFrame(list(measured.items()), "metric string, value double")


def test_system_gate(spark):
    rows = gates.system_gate(values(spark, throughput=612.34567, p50_latency_ms=100.0, other=1.0))
    found = {r["metric"]: r for r in rows.collect()}
    assert list(r["metric"] for r in rows.orderBy("ordinal").collect()) == [
        c.metric for c in gates.SYSTEM_CRITERIA
    ]
    assert found["throughput"]["passed"] and found["throughput"]["value"] == 612.3457
    assert found["throughput"]["target_text"] == "Target > 500 rec/s"
    assert found["p50_latency_ms"]["status"] == "[FAIL]"
    assert found["e2e_latency_s"]["status"] == "Data unavailable"
    assert found["training_time_s"]["target_text"] == "Reference only"
    verdict = gates.verdict(rows).first()
    assert tuple(verdict) == (2, 1, False)


def test_information_only_metric(spark):
    row = gates.system_gate(values(spark, training_time_s=3.0)).filter("value is not null").first()
    assert (row["passed"], row["status"], row["operator"]) == (None, "[INFO]", "")


def test_verdict_of_nothing_is_true(spark):
    rows = gates.gate_rows(values(spark, x=1.0), gates.SYSTEM_CRITERIA)
    assert gates.verdict(rows).first()["meets_all"] is True


def test_quality_gate_compares_rounded_metrics(spark):
    metrics = spark.createDataFrame([(0.8001, 0.75, 0.9, 0.78)], "accuracy double, precision double, recall double, f1_score double")
    found = {r["metric"]: r["passed"] for r in gates.quality_gate(metrics).collect()}
    assert found == {"accuracy": True, "precision": False, "recall": True, "f1_score": True}


def test_unknown_operator(spark):
    with pytest.raises(ValueError):
        gates.gate_rows(values(spark, a=1.0), [gates.Criterion("a", "A", "!=", 1.0)])


@pytest.fixture
def folder(tmp_path):
    def report(name, text):
        (tmp_path / name).write_text(text)

    report("producer_a_rate0_scale1_100.json", '{"target_rate": 0, "avg_rate": 900.9}')
    report("producer_a_rate0_scale1_200.json", '{\n "target_rate": 0,\n "avg_rate": 700.5,\n "x": 1}')
    report("producer_b_rate0_scale1_200.json", '{"target_rate": 0, "avg_rate": 1.0}')
    report("producer_a_rate500_scale1_50.json", '{"target_rate": 500, "avg_rate": 700.1}')
    report("producer_a_rate9_scale1_60.json", '{"target_rate": 9}')
    report("producer_a_rate8_scale1_60.json", '{"target_rate": -8, "avg_rate": 1}')
    report("producer_a_rate7_scale1_60.json", "nothing")
    report("producer_a_rate6_scale1_last.json", '{"target_rate": 6, "avg_rate": 1}')
    report("producer_a_rate5_scale1_61.json", '[{"target_rate": 5, "avg_rate": 1}]')
    report("producer_a_rate4_scale1_62.json", '{"target_rate": 4, "avg_rate": 1} more')
    report("producer_a_rate3_scale1_63.json", '{"target_rate": 3, "avg_rate": "1"}')
    report("producer_a_rate2_scale1_64.json", "")
    report("consumer_1.json", '{"target_rate": 5, "avg_rate": 1}')
    return tmp_path


def test_throughput_report(spark, folder):
    rows = reports.throughput_report(results.read_run_reports(spark, str(folder))).collect()
    assert [(r["rate_label"], r["avg_rate"], r["shown_rate"], r["is_max"]) for r in rows] == [
        ("500 rec/s", 700.1, 700, True),
        ("Burst Mode", 700.5, 700, True),
    ]


def test_no_reports(spark, tmp_path):
    rows = reports.throughput_report(results.read_run_reports(spark, str(tmp_path / "none"))).collect()
    assert [(r["rate_label"], r["avg_rate"], r["is_max"]) for r in rows] == [("No Data", 0.0, True)]
    assert results.latest_file(spark, str(tmp_path / "none")) is None


def test_latest_file_is_by_modification_time(spark, folder):
    assert results.latest_file(spark, str(folder), "nothing_*.json") is None
    os.utime(folder / "producer_a_rate9_scale1_60.json", (2_000_000_000, 2_000_000_000))
    assert results.latest_file(spark, str(folder)).endswith("producer_a_rate9_scale1_60.json")


def test_run_report_document(spark, tmp_path):
    summary = spark.createDataFrame(
        [(500, 5, 10, 1, 2.0, 5.0, 7, 9)],
        "target_rate bigint, scale_factor bigint, total_sent bigint, total_errors bigint, "
        "total_time_s double, avg_rate double, p50 bigint, p99 bigint",
    )
    report = results.run_reports_of(summary).first()
    path = results.write_run_report(spark, report, str(tmp_path), 1700)
    assert path.endswith("producer_spark_rate500_scale5_1700.json")
    back = results.read_run_reports(spark, str(tmp_path)).first()
    assert {n: back[n] for n in schema.RUN_REPORT.names} == report.asDict()
    assert back["reported_at"] == 1700


def test_latest_rows(spark):
    frame = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 2, 4), ("b", 0, 1)], "k string, ts int, id int")
    found = {r["k"]: r["id"] for r in reports.latest_per_key(frame, ["k"], "ts", "id").collect()}
    assert found == {"a": 4, "b": 1}
    assert reports.latest_row(frame, "ts", "id").first()["id"] == 4
    assert reports.max_throughput(frame, "ts").first()["max_rate"] == 2
