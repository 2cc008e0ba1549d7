"""Delimited text: normalising delimiters, lenient typed reading, writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import schema
from cohortlake.functions import scalars
from cohortlake.operators import records

# Quotes inside a cell are doubled, not escaped, as most tools write them, and blanks belong to it.
_QUOTING = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

FILE_ORDER = ("_file", "_block", "_row")


def read_cells(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """All cells as text, columns named by the header row; types are never guessed.

    Files stay splittable unless cells may hold line breaks (``multi_line``).
    """
    reader = spark.read.options(header=True, sep=sep, inferSchema=False, **_QUOTING)
    return reader.option("multiLine", multi_line).csv(path)


def normalize_delimited(
    spark: SparkSession,
    source: str,
    target: str,
    sep: str = ";",
    target_sep: str = ",",
    multi_line: bool = False,
) -> None:
    """Rewrite delimited files with another separator; cells are passed through as text.

    Blanks around a cell, quotes and separators inside it stay. Set ``multi_line`` where quoted
    cells hold line breaks; a file is then read by one task. An empty cell stays empty, quoted or not.
    """
    write_table_csv(read_cells(spark, source, sep, multi_line), target, sep=target_sep)


_LENIENT = {
    T.IntegerType(): scalars.lenient_int,
    T.DoubleType(): scalars.lenient_double,
    T.StringType(): scalars.lenient_string,
}
_MISSING = {T.IntegerType(): 0, T.DoubleType(): 0.0, T.StringType(): ""}


def read_lenient_csv(
    spark: SparkSession,
    path: str,
    mapping: Mapping[str, str] = schema.HEADERS,
    fields: T.StructType = schema.RAW_RECORD,
    sep: str = ",",
    file_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Typed records from text: a cell that does not fit, or a missing column, is the default.

    With ``file_order`` the columns ``_file, _block, _row`` say where each record stood; ordering
    by them gives the order of the files' lines.
    """
    cells = read_cells(spark, path, sep, multi_line)
    places = []
    if file_order:
        cells = with_places(cells)
        places = [F.col(name) for name in FILE_ORDER]
    named = records.rename_columns(records.trim_headers(cells), mapping)
    present = set(named.columns)
    typed = [
        (
            _LENIENT[column.dataType](F.col(column.name))
            if column.name in present
            else F.lit(_MISSING[column.dataType]).cast(column.dataType)
        ).alias(column.name)
        for column in fields.fields
    ]
    return named.select(*typed, *places)


def with_places(cells: DataFrame) -> DataFrame:
    """Add ``_file, _block, _row``: ordering by them gives the order of the files' lines."""
    return cells.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def write_table_csv(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = ","
) -> None:
    """Write the columns in the given order under a header; missing columns and nulls are blank."""
    if columns is not None:
        present = set(df.columns)
        df = df.select(
            *(F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns)
        )
    df.write.mode("overwrite").options(header=True, sep=sep, **_QUOTING).csv(path)


def export_dashboard(scored: DataFrame, path: str, with_split: bool = False) -> None:
    """The dashboard's columns of all scored rows, written by the executors in parallel."""
    extra = ["is_train"] if with_split else []
    write_table_csv(records.select_columns(scored, [*schema.DASHBOARD_COLUMNS, *extra]), path)
