"""Latency samples, histograms, exact percentiles and run totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions import histogram, scalars
from cohortlake.operators.records import has_event_time
from cohortlake.session import materialize

_PART_BITS = 12  # a step of the exact percentiles cuts a part into 4,096

#: Size of the quantile sketches, and share of the rows that a rank's bracket reaches to either side.
SKETCH_K, SKETCH_ROOM = 4096, 0.005


def latency_samples(
    df: DataFrame,
    mode: int,
    ok: str = "ok",
    send_us: str = "send_us",
    queue_us: str = "queue_us",
    name: str = "latency_us",
) -> DataFrame:
    """The durations a run records.

    Mode 1 takes successful sends only, from the moment they leave; mode 0 takes every send,
    failed ones too, from the moment it was handed over, so the wait in the queue counts.
    """
    if mode == 1:
        return df.filter(F.col(ok)).withColumn(name, F.col(send_us))
    if mode == 0:
        return df.withColumn(name, F.col(queue_us) + F.col(send_us))
    raise ValueError(f"unknown latency mode: {mode}")


def latency_samples_by_mode(df: DataFrame, ok: str = "ok", send_us: str = "send_us",
                            queue_us: str = "queue_us") -> DataFrame:
    """Both modes from one scan, as rows ``(mode, latency_us)``."""
    handed_over = F.struct(
        F.lit(0).alias("mode"), (F.col(queue_us) + F.col(send_us)).alias("latency_us")
    )
    left = F.struct(F.lit(1).alias("mode"), F.col(send_us).alias("latency_us"))
    samples = F.when(F.col(ok), F.array(handed_over, left)).otherwise(F.array(handed_over))
    return df.select(F.inline(samples))


def bucket_counts(df: DataFrame, value: str = "latency_us", by: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Rows per bucket; buckets combine on the map side. Also of a stream."""
    top = histogram.bucket_top(F.col(value), digits).alias("bucket_top")
    return df.groupBy(*by, top).agg(F.count("*").alias("rows"))


def merge_buckets(tables: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """One bucket table of several with the same digits: buckets line up, so their counts add."""
    columns = [*by, "bucket_top", "rows"]
    every = reduce(DataFrame.unionByName, [table.select(*columns) for table in tables])
    return every.groupBy(*by, "bucket_top").agg(F.sum("rows").alias("rows"))


def running_shares(buckets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bucket counts with the running share; the window sees one row per bucket of a group."""
    ordered = Window.partitionBy(*by).orderBy("bucket_top")
    running = F.sum("rows").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("rows").over(Window.partitionBy(*by))
    return buckets.select(
        *by, "bucket_top", "rows", running.alias("rows_up_to"), total.alias("total_rows")
    ).withColumn("share_up_to", F.col("rows_up_to") / F.col("total_rows"))


def latency_histogram(
    df: DataFrame, value: str = "latency_us", by: Sequence[str] = (), digits: int = 3
) -> DataFrame:
    """Rows per bucket and the running share."""
    return running_shares(bucket_counts(df, value, by, digits), by)


def _rank(total: Column, per_mille: Column) -> Column:
    """Nearest rank, in whole numbers: the smallest rank that covers the share, at least 1."""
    return F.greatest(_div(total * per_mille + 999, F.lit(1000)), F.lit(1).cast("bigint"))


def _div(value: Column, by: Column) -> Column:
    """Whole-number division, exact over the whole bigint range."""
    return F.call_function("div", value, by)


def histogram_percentiles(hist: DataFrame, per_mille: dict[str, int], by: Sequence[str] = ()) -> DataFrame:
    """Percentiles as a histogram reports them: the top of the bucket that holds the rank."""
    picks = []
    for name, share in per_mille.items():
        covers = F.col("rows_up_to") >= _rank(F.col("total_rows"), F.lit(share).cast("bigint"))
        picks.append(F.min(F.when(covers, F.col("bucket_top"))).alias(name))
    return hist.groupBy(*by).agg(*picks)


def _locate(counts: DataFrame, keys: Sequence[str], position: str, rank: str) -> DataFrame:
    """Per key, the position whose running count reaches the rank, and the rank left inside it."""
    ordered = Window.partitionBy(*keys).orderBy(position)
    running = F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", running)
    hit = (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_rows") < F.col(rank))
    return placed.filter(hit).withColumn(rank, F.col(rank) - F.col("_upto") + F.col("_rows"))


def _brackets(rows: DataFrame, by: str, per_mille: dict[str, int]) -> DataFrame:
    """Per group and percentile its rank, and values that very probably lie on both sides of it.

    One pass: a quantile sketch per task and group, merged. A sketch of ``SKETCH_K`` is off by a
    quarter of ``SKETCH_ROOM`` of the rows at most in 99 of 100 cases.
    """
    sketched = rows.groupBy(by).agg(
        F.kll_sketch_agg_bigint("_v", F.lit(SKETCH_K)).alias("_sketch"),
        F.count("*").alias("_total"),
        F.min("_v").alias("_least"),
        F.max("_v").alias("_most"),
    )
    shares = []
    for name, share in per_mille.items():
        below, above = share / 1000 - SKETCH_ROOM, share / 1000 + SKETCH_ROOM
        value = lambda at: F.kll_sketch_get_quantile_bigint("_sketch", F.lit(at))
        shares.append(F.struct(
            F.lit(name).alias("_name"),
            _rank(F.col("_total"), F.lit(share).cast("bigint")).alias("_rank"),
            (value(below) if below > 0 else F.col("_least")).alias("_low"),
            (value(above) if above < 1 else F.col("_most")).alias("_high"),
        ))
    return sketched.select(by, "_total", "_least", "_most", F.inline(F.array(*shares)))


def _inside(rows: DataFrame, brackets: DataFrame, by: str) -> DataFrame:
    """How often each value inside a bracket occurs, and under null the rows below it. One pass."""
    held = F.collect_list(F.struct("_name", "_low", "_high")).alias("_held")
    within = rows.join(brackets.groupBy(by).agg(held), by).select(by, "_v", F.inline("_held")).where("_v <= _high")
    kept = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))
    return within.groupBy(by, "_name", kept.alias("_v")).agg(F.count("*").alias("_n"))


def latency_percentiles(
    df: DataFrame,
    value: str,
    per_mille: dict[str, int],
    by: str,
    by_values: Sequence | None = None,
) -> DataFrame:
    """Exact nearest-rank percentiles of a non-negative bigint column, per group.

    Two passes over ``df`` whatever its values are. The first takes a quantile sketch per group, which
    gives each rank a bracket of about a hundredth of the rows. The second counts the values inside
    the brackets and the rows below, combined on the map side, into a written table; on that table the
    rank is found by counting up to 4,096 cuts of the bracket at a time, so no task sees more than
    these for a group and percentile. Should a sketch be so far off that a rank lies outside, its
    bracket becomes the whole range and is counted again. Negative values are an error. All groups are
    taken from the data; ``by_values`` asks for some of them only.
    """
    rows = df.filter(F.col(value).isNotNull()).select(by, F.col(value).cast("bigint").alias("_v"))
    if by_values is not None:
        rows = rows.filter(F.col(by).isin(list(by_values)))
    brackets = materialize(_brackets(rows.where(F.col(by).isNotNull()), by, per_mille), "brackets")
    least = brackets.agg(F.min("_least")).first()[0]
    if least is not None and least < 0:
        raise ValueError(f"negative value: {least}")
    inside = materialize(_inside(rows, brackets, by), "inside-brackets")
    found, missed = _ranked(inside, brackets, by)
    if not missed.isEmpty():
        wide = missed.withColumns({"_low": F.col("_least"), "_high": F.col("_most")})
        again = materialize(_inside(rows, wide, by), "inside-range")
        rest, _ = _ranked(again, wide, by)
        found, inside = found.unionByName(rest), inside.join(wide, [by, "_name"], "left_anti").unionByName(again)
    found = _narrowed(inside.where("_v is not null"), materialize(found, "ranks"), by)
    return found.groupBy(by).agg(
        F.max("_total").alias("samples"),
        *(F.max(F.when(F.col("_name") == name, F.col("_low"))).alias(name) for name in per_mille),
    )


def _ranked(inside: DataFrame, brackets: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Brackets with the rank inside them, and those whose rank lies outside."""
    sizes = inside.groupBy(by, "_name").agg(
        F.sum(F.when(F.col("_v").isNull(), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)).alias("_size"),
    )
    placed = brackets.join(sizes, [by, "_name"], "left").fillna(0, ["_below", "_size"])
    hit = (F.col("_rank") > F.col("_below")) & (F.col("_rank") <= F.col("_below") + F.col("_size"))
    found = placed.where(hit).select(
        by, "_name", (F.col("_rank") - F.col("_below")).alias("_rank"), "_total", "_low", "_high"
    )
    return found, placed.where(~hit).select(*brackets.columns)


def _narrowed(values: DataFrame, found: DataFrame, by: str) -> DataFrame:
    """The value at each rank, as ``_low``: brackets are cut until a part is one value."""
    widest = found.agg(F.max(F.col("_high") - F.col("_low"))).first()[0] or 0
    bits = int(widest).bit_length()
    found = found.drop("_high")
    for shift in range(max(0, bits - _PART_BITS), -_PART_BITS, -_PART_BITS):
        shift = max(0, shift)
        apart = values.join(found, [by, "_name"]).withColumn("_apart", F.col("_v") - F.col("_low"))
        inside = apart.where((F.col("_apart") >= 0) & (F.shiftright("_apart", bits) == 0))
        counts = inside.groupBy(
            by, "_name", "_low", "_rank", "_total", F.shiftright("_apart", shift).alias("_cut")
        ).agg(F.sum("_n").alias("_rows"))
        found = _locate(counts, [by, "_name"], "_cut", "_rank").select(
            by, "_name", "_rank", "_total", (F.col("_low") + F.shiftleft("_cut", shift)).alias("_low")
        )
        bits = shift
        if not shift:
            break
    return found


def run_summary(
    df: DataFrame, by: Sequence[str] = (), ok: str = "ok", ts_us: str = "ts_us"
) -> DataFrame:
    """Sent and failed totals, elapsed seconds and the rate reached; a run of no length has rate 0."""
    elapsed = (F.max(ts_us) - F.min(ts_us)) / F.lit(1_000_000.0)
    totals = df.groupBy(*by).agg(
        F.count_if(F.col(ok)).alias("total_sent"),
        F.count_if(~F.col(ok)).alias("total_errors"),
        elapsed.alias("total_time_s"),
    )
    rate = scalars.safe_ratio(F.col("total_sent"), F.col("total_time_s"))
    return totals.withColumn("avg_rate", rate)


def mean_latency_s(df: DataFrame, now_ms: int, ts: str = "event_ts_ms") -> DataFrame:
    """Rows that carry an event time and their mean age in seconds.

    NULL if there are none, and if the mean is negative: such stamps lie ahead and measure nothing.
    """
    mean = F.avg(scalars.latency_ms(F.lit(now_ms).cast("bigint"), F.col(ts)))
    return has_event_time(df, ts).agg(
        F.count("*").alias("stamped_rows"),
        F.when(mean >= 0, scalars.ms_to_s(mean)).alias("e2e_latency_s"),
    )
