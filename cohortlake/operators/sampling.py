"""Counts by label, balanced class weights and reproducible splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake import schema


def count_rows(df: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"))


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return count_rows(df, [label])


def class_weights(
    df: DataFrame,
    label: str = "label",
    n_classes: int = schema.CLASS_COUNT,
) -> DataFrame:
    """``total / (n_classes * count)`` per label; an absent class does not change the divisor.

    The rows are reduced to one per label before the total is taken over them.
    """
    counts = label_distribution(df, label)
    total = F.sum("rows").over(Window.partitionBy())
    weight = total.cast("double") / (F.lit(n_classes) * F.col("rows"))
    return counts.select(label, "rows", weight.alias("weight"))


def apply_weights(
    df: DataFrame,
    weights: DataFrame,
    codes: Mapping[str, int] = schema.LABELS,
    label: str = "label",
    default: float = 1.0,
    name: str = "class_weight",
) -> DataFrame:
    """Look each row's weight up by label; labels without a class keep the default.

    Only the known classes are looked up, one weight each, so the broadcast side has at most as
    many rows as there are classes, whatever the data holds.
    """
    lookup = (
        weights.filter(F.col(label).isin(list(codes.values())))
        .groupBy(label)
        .agg(F.max("weight").alias("_weight"))
    )
    joined = df.join(F.broadcast(lookup), label, "left")
    return joined.select(*df.columns, F.coalesce("_weight", F.lit(default)).alias(name))


def key_percentile(key: Column) -> Column:
    """A number 0..99 from the MD5 of a key's text: the same on every engine and partitioning."""
    digest = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % 100


def split_key(df: DataFrame, key: str, fallback: Sequence[str] | None = None) -> Column:
    """The text that decides a row's part: its key, or the text of ``fallback`` where that is missing.

    A NULL or empty key names no row, so all such rows would otherwise fall into one part. By default
    ``fallback`` is the whole row, and a scan then reads every column; name some where the table is
    wide, or none where the key is never missing.
    """
    names = df.columns if fallback is None else fallback
    text = F.col(key).cast("string")
    if not names:
        return F.coalesce(text, F.lit(""))
    whole = F.concat_ws("|", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names))
    return F.when(F.coalesce(text, F.lit("")) == "", whole).otherwise(text)


def with_split(
    df: DataFrame,
    key: str = "event_seq",
    pct: int = 80,
    name: str = "is_train",
    fallback: Sequence[str] | None = None,
) -> DataFrame:
    """Mark ``pct`` percent of the keys as training rows. No shuffle and no random state."""
    return df.withColumn(name, key_percentile(split_key(df, key, fallback)) < pct)


def split(
    df: DataFrame, key: str = "event_seq", pct: int = 80, fallback: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The training rows and the others; every row is in one of them."""
    chosen = key_percentile(split_key(df, key, fallback)) < pct
    return df.filter(chosen), df.filter(~chosen)


def split_random(
    df: DataFrame, train_share: float = 0.8, seed: int = schema.SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split; its result depends on how the input is partitioned."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test
