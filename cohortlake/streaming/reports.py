"""Reports that are kept up to date while their rows arrive.

Both write each batch's change as a unit of a ``CommittedFolder``; a batch that is repeated after a
failure finds its unit there and changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlake.functions import scalars
from cohortlake.operators import reports
from cohortlake.operators.records import has_event_time
from cohortlake.streaming.delivery import CommittedFolder


def _unit(batch: int) -> str:
    """Names of units sort as their batches do."""
    return f"{batch:019d}"


def _started(writer, checkpoint: str, until_drained: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if until_drained else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_latest(
    rows: DataFrame,
    folder: CommittedFolder,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    tiebreak: str,
    until_drained: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Keep the newest row of each key of a stream: greatest whole-number ``ts``, then smallest ``tiebreak``.

    The state holds one row per key, dealt over the cluster by key; tasks combine a batch's rows of a
    key before they are shuffled. A row that arrives late but is older changes nothing. Each batch
    commits the keys it had rows of; ``latest_rows`` reads the table.
    """
    others = [name for name in rows.columns if name not in keys]
    # the complement reverses the order of whole numbers without overflow; a missing time is oldest
    order = F.struct(F.col(ts).isNull(), F.bitwise_not(F.col(ts).cast("bigint")), F.col(tiebreak))
    newest = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row")).select(*keys, "_row.*")
    columns = rows.columns

    def store(changed: DataFrame, batch: int) -> None:
        folder.write(_unit(batch), changed.select(*columns))

    return _started(newest.writeStream.outputMode("update").foreachBatch(store), checkpoint, until_drained, interval)


def latest_rows(folder: CommittedFolder, keys: Sequence[str]) -> DataFrame:
    """The newest row per key as of the last batch: of each key the one committed last."""
    return reports.latest_per_key(folder.read(), keys, "unit").drop("unit")


def stream_delay(
    records: DataFrame,
    folder: CommittedFolder,
    checkpoint: str,
    arrived_ms: Column,
    width_ms: int = 60_000,
    lateness_ms: int = 600_000,
    ts: str = "event_ts_ms",
    until_drained: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Delay between event and arrival per window of event time, while records arrive.

    A window closes when an earlier batch held an event ``lateness_ms`` past its end. Records of
    closed windows are counted as late and left out of the mean, so a window that was reported does not
    change any more. Each batch commits counts and sums per window it touched, combined on the map
    side; ``delay_windows`` adds them up. Records without an event time are not measured.
    """
    newest: int | None = None

    def store(batch: DataFrame, number: int) -> None:
        nonlocal newest
        if newest is None:
            newest = _newest(folder, ts)
        if folder.log.has(_unit(number)):
            return
        start = F.col(ts) - F.pmod(F.col(ts), F.lit(width_ms))
        late = F.lit(False) if newest is None else start + F.lit(width_ms + lateness_ms) <= F.lit(newest)
        delay = scalars.latency_ms(arrived_ms, F.col(ts))
        part = has_event_time(batch, ts).groupBy(start.cast("bigint").alias("window_start_ms")).agg(
            F.count_if(~late).alias("rows"),
            F.coalesce(F.sum(F.when(~late, delay)), F.lit(0)).cast("bigint").alias("delay_ms"),
            F.count_if(late).alias("late_rows"),
            F.max(ts).cast("bigint").alias(ts),
        )
        folder.write(_unit(number), part)
        last = folder.read_unit(_unit(number)).agg(F.max(ts)).first()[0]
        newest = max(x for x in (newest, last, 0) if x is not None)

    return _started(records.writeStream.foreachBatch(store), checkpoint, until_drained, interval)


def _newest(folder: CommittedFolder, ts: str) -> int | None:
    try:
        return folder.read().agg(F.max(ts)).first()[0]
    except FileNotFoundError:
        return None


def delay_windows(folder: CommittedFolder) -> DataFrame:
    """``window_start_ms, stamped_rows, mean_delay_s, late_rows`` of all batches so far."""
    summed = folder.read().groupBy("window_start_ms").agg(
        F.sum("rows").alias("stamped_rows"), F.sum("delay_ms").alias("delay_ms"), F.sum("late_rows").alias("late_rows")
    )
    mean = F.when(F.col("stamped_rows") > 0, scalars.ms_to_s(F.col("delay_ms") / F.col("stamped_rows")))
    return summed.select("window_start_ms", "stamped_rows", mean.alias("mean_delay_s"), "late_rows")
