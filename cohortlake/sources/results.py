"""Run reports and training results: small JSON documents and the folders that hold them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import schema
from cohortlake.functions import scalars
from cohortlake.session import file_system

REPORT_GLOB = "producer_*.json"


def run_reports_of(summary: DataFrame, impl: str = "spark") -> DataFrame:
    """Run totals and percentiles in the shape of the report document."""
    return summary.select(
        F.lit(impl).alias("impl"),
        "target_rate",
        "scale_factor",
        "total_sent",
        "total_errors",
        "total_time_s",
        "avg_rate",
        F.struct("p50", "p99").alias("latency_us"),
    )


def write_document(spark: SparkSession, path: str, text: str) -> None:
    """One small file under a name of its own, on whatever file system the path names."""
    fs, hadoop_path = file_system(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def write_run_report(spark: SparkSession, report: Row, folder: str, epoch_s: int) -> str:
    """One run's document under its conventional name; returns the path."""
    name = (
        f"producer_{report['impl']}_rate{report['target_rate']}"
        f"_scale{report['scale_factor']}_{epoch_s}.json"
    )
    path = f"{folder}/{name}"
    write_document(spark, path, json.dumps(report.asDict(recursive=True), indent=2))
    return path


def report_files(spark: SparkSession, folder: str, glob: str = REPORT_GLOB) -> DataFrame:
    """Name, path and modification time of the matching files; their content is not read.

    A folder that does not exist has no files.
    """
    empty = spark.range(0).select(
        F.lit("").alias("file_name"),
        F.lit("").alias("path"),
        F.current_timestamp().alias("modified"),
    )
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        F.col("modificationTime").alias("modified"),
    )


def latest_file(spark: SparkSession, folder: str, glob: str = REPORT_GLOB) -> str | None:
    """Path of the matching file written last, None when there is none."""
    files = report_files(spark, folder, glob)
    return files.agg(F.max_by("path", F.struct("modified", "path")).alias("path")).first()["path"]


def read_report(spark: SparkSession, path: str | None) -> DataFrame:
    """The one report document at a path, whatever its name; no row without a path or a valid document."""
    if path is None:
        return spark.createDataFrame([], schema.RUN_REPORT)
    strict = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}
    parsed = F.from_json("value", schema.RUN_REPORT, strict)
    found = spark.read.text(path, wholetext=True).select(F.explode(F.array(parsed)).alias("report"))
    return found.where("report.avg_rate is not null").select("report.*")


def read_run_reports(spark: SparkSession, folder: str, glob: str = REPORT_GLOB) -> DataFrame:
    """All report documents with their file name and the time in it.

    Documents that are not valid JSON, or whose name carries no time, are skipped. A missing
    folder gives no rows.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    try:
        documents = reader.text(folder, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schema.RUN_REPORT)
        return empty.withColumns(
            {"file_name": F.lit(""), "reported_at": F.lit(None).cast("bigint")}
        )
    # As an array's only element, so that anything beside the one object breaks the array.
    in_array = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    parsed = F.from_json(
        in_array,
        T.ArrayType(schema.RUN_REPORT),
        {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"},
    )
    # The parse sits in a generator, so that no filter repeats it.
    loaded = documents.select(F.col("_metadata.file_name").alias("file_name"), F.explode(F.array(parsed)).alias("all"))
    loaded = loaded.filter(F.size("all") == 1).select("file_name", F.col("all")[0].alias("report"))
    named = loaded.select(
        "report.*",
        "file_name",
        scalars.file_timestamp(F.col("file_name")).alias("reported_at"),
    )
    return named.filter(F.col("reported_at").isNotNull() & F.col("target_rate").isNotNull())


def training_document(
    comparison: DataFrame,
    importances: DataFrame,
    impl: str,
    timestamp: str,
    source: str,
    model_order: Sequence[str] = (),
) -> DataFrame:
    """One row, one column ``value``: the training result as a JSON document.

    Both arrays hold report rows: one per model, in the order in which they were fitted
    (``model_order``, others behind by name), and one per reported feature.
    """
    known = F.array_position(F.array(*map(F.lit, model_order)).cast("array<string>"), F.col("model"))
    place = F.when(known > 0, known).otherwise(len(model_order) + 1)
    rows = F.sort_array(F.collect_list(F.struct(place.alias("place"), F.struct(*comparison.columns).alias("row"))))
    models = comparison.agg(F.transform(rows, lambda item: item["row"]).alias("model_comparison"))
    # Most important first; equal importances in name order.
    ranked = importances.agg(
        F.sort_array(
            F.collect_list(F.struct((-F.col("importance")).alias("rank"), "feature", "importance"))
        ).alias("ranked")
    )
    features = F.transform("ranked", lambda item: F.struct(item["feature"].alias("feature"),
                                                           item["importance"].alias("importance")))
    document = F.struct(
        F.lit(impl).alias("impl"),
        F.lit(timestamp).alias("timestamp"),
        F.lit(source).alias("parquet_source"),
        F.col("model_comparison"),
        features.alias("feature_importance"),
    )
    both = models.withColumn("_one", F.lit(1)).join(ranked.withColumn("_one", F.lit(1)), "_one")
    return both.select(F.to_json(document).alias("value"))


def document_facts(documents: DataFrame) -> DataFrame:
    """What a training document says, parsed back: its models in order, its features and their order."""
    kind = (
        "impl string, timestamp string, parquet_source string, "
        "model_comparison array<struct<model: string, accuracy: double>>, "
        "feature_importance array<struct<feature: string, importance: double>>"
    )
    parsed = documents.select(F.from_json("value", kind).alias("d")).select("d.*")
    values = F.col("feature_importance.importance")
    return parsed.select(
        "impl",
        "parquet_source",
        F.array_join("model_comparison.model", ",").alias("models"),
        F.size("feature_importance").cast("bigint").alias("features"),
        (values == F.reverse(F.array_sort(values))).alias("falling"),
    )


def write_training_result(document: DataFrame, path: str) -> None:
    document.write.mode("overwrite").text(path)
