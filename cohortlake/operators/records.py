"""Record shape, derived features and row filters. Projections and filters only: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.functions import scalars


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.strip() for name in df.columns))


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = schema.HEADERS) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def derived_columns() -> dict[str, Column]:
    """The four derived features as expressions over the raw fields."""

    def pass_rate(term: str) -> Column:
        units = f"curricular_units_{term}_sem"
        return scalars.safe_ratio(F.col(f"{units}_approved"), F.col(f"{units}_enrolled"))

    def as_double(name: str) -> Column:
        return F.col(name).cast("double")

    return {
        "pass_rate_1st_sem": pass_rate("1st"),
        "pass_rate_2nd_sem": pass_rate("2nd"),
        "grade_delta": F.col("curricular_units_2nd_sem_grade")
        - F.col("curricular_units_1st_sem_grade"),
        "financial_stability_index": as_double("tuition_fees_up_to_date")
        + as_double("scholarship_holder")
        - as_double("debtor"),
    }


def enrich(df: DataFrame) -> DataFrame:
    """Add the derived features and the numeric label; batch and stream share this function."""
    label = scalars.encode_label(F.col(schema.TARGET), schema.LABELS, schema.UNKNOWN_LABEL)
    return df.withColumns(derived_columns() | {"label": label})


def project_record(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The persisted shape in its fixed order, the time stamp as a plain bigint."""
    fixed = [name for name in schema.PERSISTED if name != "event_ts_ms"]
    return df.select(*fixed, F.col("event_ts_ms").cast("bigint").alias("event_ts_ms"), *extra)


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def resolve_features(
    df: DataFrame, configured: Sequence[str] = tuple(schema.FEATURES)
) -> list[str]:
    """The configured features that the frame has, in configured order."""
    present = set(df.columns)
    return [name for name in configured if name in present]


def known_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) >= 0)


def has_event_time(df: DataFrame, ts: str = "event_ts_ms") -> DataFrame:
    return df.filter(F.col(ts) > 0)


@dataclass(frozen=True)
class Rule:
    """A named validity condition: ``low <= column`` and, if given, ``column <= high``."""

    name: str
    column: str
    low: float
    high: float | None = None
    floating: bool = False

    def holds(self) -> Column:
        value = F.col(self.column)
        inside = value >= F.lit(self.low)
        if self.high is not None:
            inside = inside & (value <= F.lit(self.high))
        if self.floating:  # NaN sorts above every number here, but is never a valid value
            inside = inside & ~F.isnan(value)
        return F.coalesce(inside, F.lit(False))


# The age range and the lower bounds of both grades.
VALIDITY_RULES = (
    Rule("age_in_range", "age_at_enrollment", 17, 70),
    Rule("grade_1st_sem", "curricular_units_1st_sem_grade", 0, floating=True),
    Rule("grade_2nd_sem", "curricular_units_2nd_sem_grade", 0, floating=True),
)


def valid_records(df: DataFrame, rules: Sequence[Rule] = VALIDITY_RULES) -> DataFrame:
    return df.filter(reduce(lambda left, right: left & right, (r.holds() for r in rules)))


def validity_report(df: DataFrame, rules: Sequence[Rule] = VALIDITY_RULES) -> DataFrame:
    """One row per rule with the rows that break it, all rules in a single pass."""
    broken = df.agg(
        F.count("*").alias("total_rows"),
        *(F.count_if(~rule.holds()).alias(rule.name) for rule in rules),
    )
    return broken.unpivot(
        "total_rows", [rule.name for rule in rules], "rule", "failed_rows"
    ).select("rule", "failed_rows", "total_rows")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its missing cells, counted before defaults hide them."""
    counted = df.agg(*(F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in columns))
    return counted.unpivot([], list(columns), "column", "null_cells")


def drop_invalid_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a missing or not-a-number feature, as the vector assembler would."""
    types = dict(df.dtypes)

    def usable(name: str) -> Column:
        present = F.col(name).isNotNull()
        return present & ~F.isnan(name) if types[name] in ("double", "float") else present

    return df.filter(reduce(lambda left, right: left & right, map(usable, columns)))
