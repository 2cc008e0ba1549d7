"""Rate-limited replay of a numbered table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.streaming.delivery import CommitLog, CommittedFolder


def paced_replay(
    table: DataFrame,
    rows: int,
    rate: int,
    iterations: int,
    deliver: Callable[[DataFrame], None],
    checkpoint: str,
    seq: str = "seq",
    log: CommitLog | None = None,
) -> int:
    """Send ``rows`` records numbered in ``seq``, ``rate`` of them a second, ``iterations`` times in order.

    The rate source's counter says which rows are due; it survives a restart with the checkpoint. Each
    batch reads only the due range of ``seq``, which the statistics of a table stored in that order
    find without a join. Records carry ``iteration``, ``event_id`` and ``event_ts_ms``, the time their
    turn came. Returns the number sent.

    A batch that is repeated after a failure is delivered again unless ``log`` has it: a unit is
    recorded there once ``deliver`` has returned. Only rows whose delivery itself was cut short are
    then sent a second time, under the same ``event_id``; ``replay_into`` leaves no such rest.
    """

    def once(unit: str, due: DataFrame) -> None:
        if log is None:
            deliver(due)
        elif not log.has(unit):
            deliver(due)
            log.record(unit)

    return replay_units(table, rows, rate, iterations, once, checkpoint, seq)


def replay_into(
    folder: CommittedFolder,
    table: DataFrame,
    rows: int,
    rate: int,
    iterations: int,
    checkpoint: str,
    seq: str = "seq",
) -> int:
    """The paced replay into a folder in which every record counts exactly once, whatever fails when."""
    return replay_units(table, rows, rate, iterations, folder.write, checkpoint, seq)


def replay_units(
    table: DataFrame,
    rows: int,
    rate: int,
    iterations: int,
    deliver: Callable[[str, DataFrame], object],
    checkpoint: str,
    seq: str = "seq",
) -> int:
    """The paced replay with a name for all that is delivered at once.

    A repeated batch has the same rows under the same names: its range comes from the checkpoint.
    """
    if rate < 1:
        raise ValueError("a paced replay needs a rate of at least one record a second")
    total = rows * iterations
    kept = [name for name in table.columns if name not in ("iteration", "event_id", "event_ts_ms")]
    reached = 0

    def send(batch: DataFrame, number: int) -> None:
        nonlocal reached
        first, last, since = batch.agg(F.min("value"), F.max("value"), F.min(F.unix_millis("timestamp"))).first()
        if first is None:
            return
        at = first
        while at <= min(last, total - 1):
            iteration, low = divmod(at, rows)
            high = min(rows - 1, low + min(last, total - 1) - at)
            turn = F.lit(iteration * rows - first) + F.col(seq)
            due = table.where(F.col(seq).between(low, high)).select(
                *kept,
                F.lit(iteration).cast("bigint").alias("iteration"),
                F.concat_ws("_", F.lit(iteration), seq).alias("event_id"),
                (F.lit(since) + F.call_function("div", turn * 1000, F.lit(rate))).cast("bigint").alias("event_ts_ms"),
            )
            deliver(f"{number}-{iteration}", due)
            at += high - low + 1
        reached = last + 1

    ticks = table.sparkSession.readStream.format("rate").option("rowsPerSecond", rate).load()
    query = ticks.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).start()
    try:
        while reached < total and not query.awaitTermination(0.2):
            pass
    finally:
        query.stop()
    return total


def replay_stream(numbered: DataFrame, rate: int, iterations: int = 1, seq: str = "seq") -> DataFrame:
    """The paced records as a stream to build on, for tables small enough to be joined with each batch.

    ``paced_replay`` sends tables of any size.
    """
    if rate < 1:
        raise ValueError("a paced replay needs a rate of at least one record a second")
    rows = numbered.count()
    ticks = numbered.sparkSession.readStream.format("rate").option("rowsPerSecond", rate).load()
    due = ticks.filter(F.col("value") < rows * iterations).select(
        F.call_function("div", F.col("value"), F.lit(rows)).alias("iteration"),
        (F.col("value") % rows).alias(seq),
        F.unix_millis("timestamp").alias("event_ts_ms"),
    )
    kept = [name for name in numbered.columns if name not in ("event_id", "event_ts_ms")]
    return due.join(numbered.select(*kept), seq).withColumn(
        "event_id", F.concat_ws("_", "iteration", seq)
    )
