"""Classification metrics from one confusion matrix per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("accuracy", "precision", "recall", "f1_score")


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (label, prediction): the only pass over the predictions, combined map-side."""
    return df.groupBy(
        *by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("rows"))


def metrics_from_confusion(confusion: DataFrame, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, rounded.

    Each cell counts towards its true class and its predicted class; adding these up per class
    gives support, predicted rows and hits without joining the matrix to itself.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    roles = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("rows").alias("support"),
            none.alias("predicted"),
            hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            none.alias("support"),
            F.col("rows").alias("predicted"),
            none.alias("hits"),
        ),
    )
    per_class = (
        confusion.select(*by, F.inline(roles))
        .groupBy(*by, "class")
        .agg(*(F.sum(name).alias(name) for name in ("support", "predicted", "hits")))
    )
    share = F.col("support") / F.sum("support").over(Window.partitionBy(*by))

    def ratio(numerator, denominator):
        return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))

    weighted = per_class.select(
        *by,
        "support",
        "hits",
        (share * ratio(F.col("hits"), F.col("predicted"))).alias("precision"),
        (share * ratio(F.col("hits"), F.col("support"))).alias("recall"),
        (share * ratio(2 * F.col("hits"), F.col("support") + F.col("predicted"))).alias("f1_score"),
    )
    return weighted.groupBy(*by).agg(
        F.round(F.sum("hits") / F.sum("support"), digits).alias("accuracy"),
        *(F.round(F.sum(name), digits).alias(name) for name in METRICS[1:]),
    )


def metric_facts(scored: DataFrame, by: Sequence[str], classes: int = 3) -> DataFrame:
    """Per group: rows counted, and whether the metrics agree with each other and beat guessing."""
    confusion = confusion_matrix(scored, by=by)
    per_label = confusion.groupBy(*by, "label").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("prediction").between(0, classes - 1), F.col("rows")).otherwise(0)).alias("known"),
    )
    totals = per_label.groupBy(*by).agg(
        F.sum("rows").alias("test_rows"),
        F.sum("known").alias("with_class"),
        (F.max("rows") / F.sum("rows")).alias("majority"),
    )
    in_range = [F.col(name).between(0, 1) for name in METRICS]
    return metrics_from_confusion(confusion, by).join(totals, list(by)).select(
        *by,
        "test_rows",
        "with_class",
        (F.abs(F.col("recall") - F.col("accuracy")) <= 1.01e-4).alias("recall_is_accuracy"),
        (F.col("accuracy") > F.col("majority")).alias("beats_majority"),
        (in_range[0] & in_range[1] & in_range[2] & in_range[3]).alias("in_range"),
    )


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    digits: int = 4,
) -> DataFrame:
    return metrics_from_confusion(confusion_matrix(df, label, prediction, by), by, digits)
