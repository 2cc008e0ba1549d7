"""Replaying a dataset: row numbers, repetition, event stamps and send schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import scalars
from cohortlake.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row position below
_COPIES_PER_CHUNK = 1 << 16


def with_sequence(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "seq",
    copies: bool = True,
) -> DataFrame:
    """Number all rows from 0 in the given order, without a single-partition window.

    The rows are range-partitioned and sorted once, and written with their position inside their
    partition; the table pins that numbering. Counting the rows of each partition gives its first
    number, one row per shuffle partition, which is broadcast.

    Ties in ``order`` fall to a hash of the whole row, which also lets the range partitioner cut
    through a hot key. Identical rows are counted before the shuffle and put back afterwards in
    bounded chunks; switch ``copies`` off where rows are known to be unique.
    """
    if copies:
        return _with_sequence_of_copies(df, order, name)
    return _numbered(df, order).select(*df.columns, F.col("_first").alias(name))


def _numbered(df: DataFrame, order: Sequence[str | Column], weight: str | None = None) -> DataFrame:
    """``df`` plus ``_first``: the summed weight (1 per row if none) of all rows before it."""
    tie = F.xxhash64(*(F.col(f"`{column}`") for column in df.columns))
    keys = [*(F.col(key) if isinstance(key, str) else key for key in order), tie]
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    table = materialize(
        sorted_rows.withColumn("_position", F.monotonically_increasing_id()), "sequence"
    ).withColumn("_chunk", F.shiftright("_position", _ROW_BITS))

    amount = F.sum(weight) if weight else F.count("*")
    sizes = table.groupBy("_chunk").agg(amount.alias("_amount"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_chunk", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_start"))
    placed = table.join(F.broadcast(starts), "_chunk")
    if weight is None:
        inside = F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    else:
        earlier = (
            Window.partitionBy("_chunk")
            .orderBy("_position")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        inside = F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    return placed.withColumn("_first", F.col("_start") + inside)


#: Blocks of files whose first numbers are broadcast (about 200 bytes each); more are joined without a hint.
_BROADCAST_BLOCKS = 200_000


def with_file_sequence(df: DataFrame, name: str = "seq") -> DataFrame:
    """Number the rows of files from 0 in the order of files and lines, without moving a row.

    ``df`` has the columns ``_file, _block, _row`` of a read with ``file_order``; they are dropped. The
    rows are written as they were read, which pins them. A block of a file is read by one task, so a
    row's place in it is known, and a prefix sum over one count per block gives the blocks' starts.
    """
    table = materialize(df, "file-sequence")
    block = ["_file", "_block"]
    sizes = table.groupBy(*block).agg(F.min("_row").alias("_least"), F.count("*").alias("_rows"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*block, "_least", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    if sizes.count() <= _BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    placed = table.join(starts, block)
    kept = [c for c in df.columns if c not in (*block, "_row")]
    return placed.select(*kept, (F.col("_start") + F.col("_row") - F.col("_least")).alias(name))


def _with_sequence_of_copies(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    counted = df.groupBy(*(F.col(f"`{column}`") for column in df.columns)).agg(
        F.count("*").alias("_copies")
    )
    numbered = _numbered(counted, order, weight="_copies")
    step, zero = F.lit(_COPIES_PER_CHUNK).cast("bigint"), F.lit(0).cast("bigint")
    # A given number of partitions: these few rows are small now, but each is about to become a
    # whole chunk, so they must not be merged into one task for their size.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = numbered.withColumn(
        "_from", F.explode(F.sequence(zero, F.col("_copies") - 1, step))
    ).repartition(spread, "_first", "_from")
    last = F.least(F.col("_from") + step, F.col("_copies")) - 1
    offset = F.explode(F.sequence("_from", last))
    return chunks.withColumn("_offset", offset).select(
        *df.columns, (F.col("_first") + F.col("_offset")).alias(name)
    )


def replicate(df: DataFrame, n: int, name: str = "iteration") -> DataFrame:
    """Every row once per iteration 0..n-1. Rows fan out where they are read: no join, no shuffle."""
    if n < 1:
        return df.withColumn(name, F.lit(0).cast("bigint")).limit(0)
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))


def stamp_event(
    df: DataFrame,
    iteration: str = "iteration",
    index: str = "seq",
    start_ms: int | None = None,
    offset_ms: Column | None = None,
) -> DataFrame:
    """Add ``event_id`` and ``event_ts_ms``: the time the row is sent, or a given start plus an offset.

    Without a start the clock is read for every row when it passes, and an offset is an error: a
    planned time that has not come is no stamp.
    """
    if start_ms is None:
        if offset_ms is not None:
            raise ValueError("planned offsets need a start")
        stamped = F.reflect(F.lit("java.lang.System"), F.lit("currentTimeMillis"))
    else:
        stamped = F.lit(start_ms).cast("bigint")
    if offset_ms is not None:
        stamped = stamped + offset_ms
    return df.withColumns(
        {
            "event_id": F.concat_ws("_", F.col(iteration), F.col(index)),
            "event_ts_ms": stamped.cast("bigint"),
        }
    )


def message_key(sequence: Column) -> Column:
    return sequence.cast("string")


def with_pace(df: DataFrame, rate: int, sequence: str = "seq", name: str = "send_offset_us") -> DataFrame:
    """Planned send offsets of a rate-limited replay."""
    return df.withColumn(name, scalars.pace_offset_us(F.col(sequence), rate))


def scale_sweep(df: DataFrame, scales: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """The replays of all scale factors from one scan, told apart by ``scale_factor``."""
    runs = [
        F.struct(F.lit(scale).alias("scale_factor"), F.lit(step).alias("iteration"))
        for scale in scales
        for step in range(scale)
    ]
    fanned = df.withColumn("_run", F.explode(F.array(*runs)))
    return fanned.select(*df.columns, "_run.scale_factor", "_run.iteration")
