"""The stages end to end: replay a dataset, ingest it, train and report, at several scales."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.functions import scalars
from cohortlake.operators import gates, latency, models, records, replay, reports
from cohortlake.session import discard, fresh_path, materialize, path_exists, stored
from cohortlake.sources import batches, delimited, messages, results
from cohortlake.streaming import ingest
from cohortlake.streaming.replay import paced_replay


def replay_dataset(
    spark: SparkSession,
    csv_path: str,
    sink: str,
    path: str | None = None,
    iterations: int = 1,
    rate: int = 0,
    start_ms: int | None = None,
    report_folder: str | None = None,
    **options,
) -> int:
    """Send a delimited file's records ``iterations`` times; returns the number of messages.

    With a rate, that many are sent a second; without one, all as fast as possible. Records carry the
    time they were sent, or ``start_ms`` plus their planned offset where a start is given. A report
    folder receives the run's totals; latencies of single sends are not known here and stay NULL.
    """
    typed = delimited.read_lenient_csv(spark, csv_path, file_order=True)
    numbered, table = stored(replay.with_file_sequence(typed), "replay")
    rows = numbered.count()
    send = F.col("iteration") * F.lit(rows) + F.col("seq")
    encoded = [replay.message_key(send), sink, path]

    def deliver(due: DataFrame, mode: str = "append") -> None:
        if start_ms is not None:
            planned = F.call_function("div", scalars.pace_offset_us(send, rate), F.lit(1000))
            due = replay.stamp_event(due, start_ms=start_ms, offset_ms=planned)
        key, *target = encoded
        messages.write_messages(messages.encode_messages(due, key), *target, mode=mode, **options)

    started = time.time()
    if rate > 0 and rows:
        if path is not None and path_exists(spark, path):
            raise FileExistsError(f"a paced replay appends to a new path: {path}")
        paced_replay(numbered, rows, rate, iterations, deliver, fresh_path(spark, "replay-checkpoint"))
    else:
        deliver(replay.stamp_event(replay.replicate(numbered, iterations)), "overwrite")
    elapsed = time.time() - started
    discard(spark, table)
    sent = rows * iterations
    if report_folder is not None:
        summary = spark.createDataFrame(
            [(rate, iterations, sent, 0, elapsed, sent / elapsed, None, None)],
            "target_rate bigint, scale_factor bigint, total_sent bigint, total_errors bigint, "
            "total_time_s double, avg_rate double, p50 bigint, p99 bigint",
        )
        report = results.run_reports_of(summary).first()
        results.write_run_report(spark, report, report_folder, int(started + elapsed))
    return sent


def ingest_messages(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    path: str | None = None,
    rows_per_file: int = schema.FILE_ROWS,
    tries: int = 3,
    **options,
) -> ingest.IngestCounters:
    """Take in what the topic or directory holds beyond the checkpoint; fail if nothing is stored.

    However long that takes; after an error of the source it goes on, ``tries`` times in all.
    """

    def start():
        stream = messages.read_messages(spark, source, path, **options)
        return ingest.stream_ingest(stream, out, checkpoint, rows_per_file, extra=("event_id",))

    counters = ingest.run_until_drained(start, tries)
    batches.assert_nonempty(spark, out)
    return counters


@dataclass
class StudyResult:
    comparison: DataFrame
    quality: DataFrame
    system: DataFrame
    meets_all: bool


def train_and_report(
    spark: SparkSession,
    parquet_dir: str,
    out_dir: str,
    report_folder: str | None = None,
    now_ms: int | None = None,
    rows_key: str = "event_id",
) -> StudyResult:
    """Fit the four models, gate the forest and the run, score all rows and write every result."""
    labelled = records.known_labels(batches.scan_parquet(spark, parquet_dir))
    if rows_key not in labelled.columns:
        labelled = labelled.withColumn(rows_key, F.xxhash64(*labelled.columns).cast("string"))
    training = models.prepare_training(labelled, key=rows_key)
    fitted = models.fit_models(training)
    # A report of four rows: stored, so that gates and files do not score the test rows again.
    comparison, compared = stored(models.compare_models(training, fitted, with_times=True), "comparison")
    best = models.best_model(comparison)
    scored = models.score(fitted[best], training.features, labelled)
    importances = models.top_features(
        models.feature_importance(spark, fitted["Random Forest"], training.columns)
    )

    row = comparison.filter(F.col("model") == best)
    quality = gates.quality_gate(row)
    now = int(time.time() * 1000) if now_ms is None else now_ms
    delay = latency.mean_latency_s(scored, now)
    values = gates.metric_values(row, ["training_time_s"]).unionByName(
        gates.metric_values(delay, ["e2e_latency_s"])
    )
    if report_folder is not None:
        points = reports.valid_points(results.read_run_reports(spark, report_folder))
        newest = reports.latest_row(points, "reported_at", "file_name")
        if newest.isEmpty():  # names without a time: the file written last
            newest = results.read_report(spark, results.latest_file(spark, report_folder))
        newest = newest.select(
            F.col("avg_rate").alias("throughput"),
            scalars.us_to_ms(F.col("latency_us.p50")).alias("p50_latency_ms"),
        )
        values = values.unionByName(
            gates.metric_values(newest, ["throughput", "p50_latency_ms"])
        )
        delimited.write_table_csv(
            reports.throughput_report(results.read_run_reports(spark, report_folder)),
            f"{out_dir}/throughput_report",
        )
    system = materialize(gates.system_gate(values), "system-gate")
    quality = materialize(quality, "quality-gate")

    finished = datetime.now(UTC)
    document = results.training_document(
        comparison, importances, "spark", finished.isoformat(), parquet_dir, list(models.MODELS)
    )
    # The latest results, and those of every run below the time it finished.
    for folder in (out_dir, f"{out_dir}/runs/{finished:%Y%m%d_%H%M%S_%f}"):
        results.write_training_result(document, f"{folder}/training_results")
        delimited.write_table_csv(comparison, f"{folder}/model_metrics", schema.MODEL_METRICS)
        delimited.write_table_csv(importances, f"{folder}/feature_importance")
        delimited.write_table_csv(quality, f"{folder}/quality_summary", schema.GATE_SUMMARY)
        delimited.write_table_csv(system, f"{folder}/system_summary", schema.GATE_SUMMARY)
    delimited.export_dashboard(scored, f"{out_dir}/dashboard")
    meets_all = gates.verdict(quality).first()["meets_all"]
    kept = spark.createDataFrame(comparison.collect(), comparison.schema)  # a row per model
    training.close()
    discard(spark, compared)
    return StudyResult(kept, quality, system, meets_all)


def scale_study(
    spark: SparkSession,
    csv_path: str,
    work_dir: str,
    scales: Sequence[int] = (1, 5, 10),
    rate: int = 0,
) -> DataFrame:
    """The whole chain once per scale factor; one row of metrics per scale and model."""
    tables = []
    for scale in scales:
        folder = f"{work_dir}/scale{scale}"
        replay_dataset(
            spark,
            csv_path,
            "parquet",
            f"{folder}/messages",
            iterations=scale,
            rate=rate,
            report_folder=f"{work_dir}/reports",
        )
        ingest_messages(
            spark, "parquet", f"{folder}/records", f"{folder}/checkpoint", f"{folder}/messages"
        )
        study = train_and_report(
            spark, f"{folder}/records", f"{folder}/results", f"{work_dir}/reports"
        )
        tables.append(study.comparison.withColumn("scale_factor", F.lit(scale)))
    table = tables[0]
    for other in tables[1:]:
        table = table.unionByName(other)
    return table
