"""Shared helper: run a function over whole texts inside Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

#: Rows whose texts are Python objects at the same time.
ROWS_AT_ONCE = 256
#: Bytes of an Arrow batch after ``bounded_batches``; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20

Scorer = Callable[[list[str | None]], list[dict]]


_held: dict = {}


def per_worker(key: tuple, make: Callable):
    """What ``make`` returns, kept in a Python worker from task to task until another key is asked for.

    One at a time, so that the memories of one operator do not stay beside those of the next.
    """
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Let go of what earlier tasks left in this Python worker, for tasks that keep nothing.

    The C library keeps freed memory below whatever was allocated last; where it can, it is told to give
    that back to the system, because the worker outlives the stage.
    """
    _held.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def bounded_batches(spark: SparkSession) -> None:
    """From now on this session sends rows to Python workers in batches of ``BATCH_BYTES``.

    An executor holds a batch several times over for each task: as vectors, as the message that is sent,
    and in the worker. Spark's own limits are 64 MB and 10,000 rows. A limit that the session sets stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


def annotate(
    docs: DataFrame, columns: list[str], name: str, fields: str, make: Callable[[], Scorer], keeps: bool = False
) -> DataFrame:
    """The given ``columns`` of ``docs`` and a struct ``name`` with what a scorer says of each text.

    ``make`` builds the scorer once per task; it gets lists of whole texts (or nulls) and returns a
    dict per text. ``keeps`` says that the scorer comes from ``per_worker``. No shuffle, and memory for
    ``ROWS_AT_ONCE`` texts beside the Arrow batch.
    """
    found = StructType.fromDDL(fields)
    kind = to_arrow_type(found)
    text = F.col("text").cast("string")
    carried = [text if c == "text" else F.col(c) for c in columns]
    plain = docs.select(*(c.alias(n) for c, n in zip(carried, columns)), *([] if "text" in columns else [text.alias("_text")]))
    at_text, kept = (columns.index("text") if "text" in columns else len(columns)), len(columns)
    schema = StructType([*plain.schema.fields[:kept], StructField(name, found)])
    names = schema.names

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        scorer = make()
        for part in parts:
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                rows = part.slice(at, ROWS_AT_ONCE)
                said = pa.array(scorer(rows.column(at_text).to_pylist()), kind)
                yield pa.RecordBatch.from_arrays([*rows.columns[:kept], said], names)

    return plain.mapInArrow(batches, schema)


def fold(doc_id, folds: int):
    """``crc32`` of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
