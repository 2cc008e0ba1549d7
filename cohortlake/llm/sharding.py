"""Two-pass external shuffle into shards, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.session import materialize

SEED = 20_240_601
SHARDS = 16
BUCKET_BYTES = 32 << 20
#: Start rows (16 bytes each) that are broadcast; more of them are joined without a hint.
BROADCAST_BUCKETS = 4_000_000


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def external_shuffle(
    records: DataFrame, size: Column, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``record`` (all columns of ``records`` as one struct), ``bucket`` and ``position`` in it.

    First pass: a seeded hash of a row's place in the scan scatters the rows uniformly into buckets
    of about ``bucket_bytes``, which one task holds in memory; equal rows and hot keys scatter like
    any others, because no value of the row decides. Second pass: each bucket is shuffled by
    ``shuffle`` (Fisher-Yates) and written to the shared folder, which fixes the order for all later
    reads. The same files, splits and seed give the same order.

    Nulls stay as they are, whole texts stay whole, an empty table gives an empty one, and columns of
    ``records`` cannot clash with the ones added, because they stay inside the struct.
    """
    total = records.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    record = F.struct(*(records[c] for c in records.columns)).alias("record")
    place = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    scattered = (
        records.select(record, place.alias("place"))
        .select("record", "place", F.pmod("place", F.lit(buckets)).alias("bucket"))
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "place")
    )
    dealt = scattered.groupBy("bucket").agg(F.shuffle(F.collect_list("record"), seed).alias("records"))
    return materialize(dealt.select("bucket", F.posexplode("records").alias("position", "record")), "shuffled")


def shards(
    records: DataFrame,
    size: Column,
    count: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``record``, ``shard`` (0 to ``count`` - 1) and ``slot`` (gapless from 0 in each shard).

    The shuffled buckets, one after the other, are cut into ``count`` runs whose row counts differ
    by at most one; the buckets' places come from one prefix sum over a row per bucket. A bucket
    lies in few shards, so writing them makes few files.
    """
    shuffled = external_shuffle(records, size, seed, bucket_bytes)
    counts = shuffled.groupBy("bucket").agg(F.count("*").alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select(
        "bucket",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"),
        F.sum("rows").over(everything).alias("total"),
    )
    if counts.count() <= BROADCAST_BUCKETS:  # at most 64 MB
        starts = F.broadcast(starts)
    place = F.col("first") + F.col("position")
    placed = shuffled.join(starts, "bucket").select("record", "total", place.alias("place"))
    shard = F.expr(f"place * {count}L div total")
    dealt = placed.select("record", "total", "place", shard.alias("shard"))
    slot = F.expr(f"place - (shard * total + {count - 1}L) div {count}L")
    return dealt.select("record", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the records of ``shards`` to one folder per shard, in slot order within each file."""
    sharded.select("record.*", F.col("shard").alias("_shard")).write.partitionBy("_shard").parquet(path)
