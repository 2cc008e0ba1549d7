"""Run reports: the latest run per target rate and the throughput report over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import scalars


def valid_points(reports: DataFrame) -> DataFrame:
    """Reports with an unsigned target rate, a measured rate and a time stamp in the name."""
    return reports.filter(
        (F.col("target_rate") >= 0) & F.col("avg_rate").isNotNull() & F.col("reported_at").isNotNull()
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str | None = None
) -> DataFrame:
    """The newest row of each key; on equal times the smallest ``tiebreak`` is kept.

    The per-partition group limit keeps one row per key and task before the shuffle, so a key
    that holds a third of the rows sends no more rows than any other.
    """
    newest: list[Column] = [F.col(ts).desc()]
    if tiebreak is not None:
        newest.append(F.col(tiebreak).asc())
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_row(df: DataFrame, ts: str, tiebreak: str | None = None) -> DataFrame:
    """The newest row of all: each task keeps one candidate."""
    order = [F.col(ts).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*order).limit(1)


def max_throughput(points: DataFrame, column: str = "shown_rate") -> DataFrame:
    return points.agg(F.max(column).alias("max_rate"))


def flag_max(points: DataFrame, column: str = "shown_rate", name: str = "is_max") -> DataFrame:
    """Mark every row that reaches the maximum. For frames already reduced to a report."""
    return points.withColumn(name, F.col(column) == F.max(column).over(Window.partitionBy()))


def order_points(points: DataFrame, column: str = "avg_rate") -> DataFrame:
    return points.orderBy(F.col(column).asc(), F.col("target_rate").asc())


def or_fallback(df: DataFrame, **row) -> DataFrame:
    """``df``, or the one given row when it is empty; columns not given are NULL."""
    fallback = df.sparkSession.range(1).select(
        *(
            F.lit(row.get(field.name)).cast(field.dataType).alias(field.name)
            for field in df.schema.fields
        )
    )
    return df.union(fallback.filter(~df.exists()))


def throughput_report(reports: DataFrame, keys: Sequence[str] = ("target_rate",)) -> DataFrame:
    """One row per target rate: label, rate as measured and as shown, the highest ones marked.

    Key by ``("target_rate", "scale_factor")`` to keep the runs of a scale sweep apart.
    """
    latest = latest_per_key(valid_points(reports), keys, "reported_at", "file_name")
    points = latest.select(
        *keys,
        scalars.rate_label(F.col("target_rate")).alias("rate_label"),
        "avg_rate",
        scalars.trunc_int(F.col("avg_rate")).alias("shown_rate"),
    )
    reported = or_fallback(points, rate_label="No Data", avg_rate=0.0, shown_rate=0)
    return order_points(flag_max(reported))
