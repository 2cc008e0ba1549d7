"""Latency histograms that grow while their samples arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlake.operators import latency
from cohortlake.streaming.delivery import CommittedFolder


def stream_histogram(
    samples: DataFrame,
    folder: CommittedFolder,
    checkpoint: str,
    value: str = "latency_us",
    by: Sequence[str] = (),
    digits: int = 3,
    until_drained: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Count the samples of a stream per bucket, over all runs with the same checkpoint.

    The counts are the state of a streaming aggregation, one row per bucket and group, so they are
    bounded by the bucket rule. Each batch commits the whole table as a unit of ``folder``;
    ``newest_buckets`` reads the last one, also while the query runs.
    """

    def store(buckets: DataFrame, batch: int) -> None:
        folder.write(f"{batch:019d}", buckets)

    counted = latency.bucket_counts(samples, value, by, digits)
    writer = counted.writeStream.outputMode("complete").foreachBatch(store).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if until_drained else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def newest_buckets(folder: CommittedFolder) -> DataFrame:
    """The bucket table of the last batch."""
    last = folder.log.records().agg(F.max("unit")).first()[0]
    if last is None:
        raise FileNotFoundError(f"no batch counted yet below {folder.path}")
    return folder.read_unit(last)
