"""Parquet tables of enriched records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.sources import compaction


class EmptyOutputError(RuntimeError):
    """A run that should have produced rows produced none."""


def write_batches(
    df: DataFrame,
    path: str,
    rows_per_file: int = schema.FILE_ROWS,
    mode: str = "overwrite",
) -> None:
    """Snappy Parquet with a bound on the rows per file.

    The default lets files of large tables reach the size of a block; ``schema.BATCH_ROWS`` gives
    the small batches of a replay.
    """
    writer = df.write.mode(mode).option("compression", "snappy")
    writer.option("maxRecordsPerFile", rows_per_file).parquet(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """All files of a directory as one table; a missing directory is a ``FileNotFoundError``.

    An unsigned time stamp column, which Spark reads as a decimal, becomes a bigint. Of files that
    ``compaction`` has merged the merged ones are read.
    """
    return compaction.union(_scans(spark, path))


def _scans(spark: SparkSession, path: str) -> list[DataFrame]:
    try:
        return compaction.scans(spark, path) or [compaction.signed_times(spark.read.parquet(path))]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Parquet directory not found: {path}") from error
        raise


def assert_nonempty(spark: SparkSession, path: str) -> None:
    """Raise unless the directory holds at least one row."""
    try:
        empty = scan_parquet(spark, path).isEmpty()
    except FileNotFoundError:
        empty = True
    except AnalysisException as error:  # a directory without any Parquet file
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        empty = True
    if empty:
        raise EmptyOutputError(f"no Parquet rows below {path}")


def rows_per_file(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of each file of a table; only the file names are read unless columns are given."""
    named = compaction.union([scan.select("_metadata.file_name", *columns) for scan in _scans(spark, path)])
    return named.groupBy("file_name").agg(F.count("*").alias("rows"))
