"""Metric gates: measured values against fixed criteria, and the overall verdict."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions import scalars

OPERATORS = (">", ">=", "<", "<=")


@dataclass(frozen=True)
class Criterion:
    """A metric's name on reports, unit and, unless for reference only, its bound."""

    metric: str
    label: str
    operator: str | None = None
    target: float | None = None
    unit: str = ""


# The quality bounds of a model.
QUALITY_CRITERIA = (
    Criterion("accuracy", "Accuracy", ">", 0.80),
    Criterion("precision", "Precision", ">", 0.75),
    Criterion("recall", "Recall", ">", 0.80),
    Criterion("f1_score", "F1-Score", ">", 0.77),
)

# The bounds of a whole run; training time is reported without a bound.
SYSTEM_CRITERIA = (
    Criterion("throughput", "Throughput", ">", 500.0, "rec/s"),
    Criterion("p50_latency_ms", "P50 Latency", "<", 100.0, "ms"),
    Criterion("e2e_latency_s", "End-to-End Latency", "<", 30.0, "seconds"),
    Criterion("training_time_s", "Training Time", unit="seconds"),
)

_CRITERIA_SCHEMA = (
    "ordinal int, metric string, label string, operator string, target double, unit string"
)


def criteria_frame(spark: SparkSession, criteria: Sequence[Criterion]) -> DataFrame:
    for criterion in criteria:
        if criterion.operator is not None and criterion.operator not in OPERATORS:
            raise ValueError(f"unsupported operator: {criterion.operator}")
    rows = [
        (position, c.metric, c.label, c.operator, c.target, c.unit)
        for position, c in enumerate(criteria)
    ]
    return spark.createDataFrame(rows, _CRITERIA_SCHEMA)


def metric_values(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """A one-row metrics frame as rows ``(metric, value)``."""
    wide = metrics.select(*(F.col(name).cast("double").alias(name) for name in names))
    return wide.unpivot([], list(names), "metric", "value")


def gate_rows(values: DataFrame, criteria: Sequence[Criterion]) -> DataFrame:
    """Every criterion with its measured value and verdict; not measured means no verdict.

    The comparison takes the value as measured, the output shows it rounded.
    """
    expected = criteria_frame(values.sparkSession, criteria)
    measured = values.filter(F.col("metric").isin([c.metric for c in criteria]))
    value, operator, target, unit = (F.col(n) for n in ("value", "operator", "target", "unit"))
    passed = scalars.compare(value, operator, target)
    return expected.join(measured, "metric", "left").select(
        "ordinal",
        "metric",
        "label",
        scalars.round_to(value, 4).alias("value"),
        "unit",
        F.coalesce(operator, F.lit("")).alias("operator"),
        "target",
        passed.alias("passed"),
        scalars.target_text(operator, target, unit).alias("target_text"),
        F.when(value.isNull(), "Data unavailable").otherwise(scalars.status_text(passed)).alias("status"),
    )


def with_verdict(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("passed").isNotNull())


def verdict(rows: DataFrame) -> DataFrame:
    """One row: whether all criteria with a verdict passed; none at all counts as passed."""
    judged = with_verdict(rows)
    return judged.agg(
        F.count("*").alias("judged"),
        F.count_if(F.col("passed")).alias("passed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("meets_all"),
    )


def quality_gate(metrics: DataFrame) -> DataFrame:
    """Gate a one-row frame of the four classification metrics."""
    return gate_rows(metric_values(metrics, [c.metric for c in QUALITY_CRITERIA]), QUALITY_CRITERIA)


def system_gate(values: DataFrame) -> DataFrame:
    """Gate rows ``(metric, value)`` of a run's throughput, latencies and training time."""
    return gate_rows(values, SYSTEM_CRITERIA)
