"""Scalar expressions over columns; all are built-in, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -2147483648, 2147483647


# The letters that a decimal number or a special name may have, and what the JVM's parser takes besides:
# type suffixes ("10d", "2.5f") and hexadecimal digits ("0x1p3").
_LAST_DIGIT = "0123456789."


def _number(cell: Column) -> Column:
    """A decimal number, an infinity or a NaN; no pattern is matched, only characters are looked at."""
    text = F.trim(cell)
    suffix = F.lower(F.right(text, F.lit(1))).isin("d", "f") & F.contains(
        F.lit(_LAST_DIGIT), F.substring(text, -2, 1)
    )
    hexadecimal = F.contains(F.lower(text), F.lit("x"))
    return F.when(~(suffix | hexadecimal), cell.try_cast("double"))


def lenient_int(cell: Column, default: int = 0) -> Column:
    """Text to int; fractions are cut off, anything else that does not fit is the default."""
    return F.coalesce(_number(cell).try_cast("int"), F.lit(default))


def lenient_double(cell: Column, default: float = 0.0) -> Column:
    """Text to double, or the default."""
    return F.coalesce(_number(cell), F.lit(default))


def lenient_string(cell: Column) -> Column:
    """The cell's text; an empty cell reads as the text of a null."""
    return F.coalesce(cell, F.lit("null"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else 0."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(0.0))


def encode_label(name: Column, codes: Mapping[str, int], unknown: int = -1) -> Column:
    """Exact, case-sensitive name to code."""
    matches = [F.when(name == text, F.lit(code)) for text, code in codes.items()]
    return F.coalesce(*matches, F.lit(unknown))


def decode_label(code: Column, codes: Mapping[str, int]) -> Column:
    """Code to name, NULL for a code without a name."""
    pairs = [F.lit(part) for text, number in codes.items() for part in (number, text)]
    return F.try_element_at(F.create_map(*pairs), code)


def pace_offset_us(sequence: Column, rate: int) -> Column:
    """Planned send offset in microseconds for a target rate; 0 means as fast as possible."""
    interval = 1_000_000 // rate if rate > 0 else 0
    return sequence.cast("bigint") * F.lit(interval).cast("bigint")


def latency_ms(now_ms: Column, stamped_ms: Column) -> Column:
    return now_ms - stamped_ms.cast("bigint")


def us_to_ms(microseconds: Column) -> Column:
    return microseconds / F.lit(1000.0)


def ms_to_s(milliseconds: Column) -> Column:
    return milliseconds / F.lit(1000.0)


def round_to(value: Column, digits: int = 4) -> Column:
    return F.round(value, digits)


def rate_label(rate: Column) -> Column:
    return F.when(rate == 0, F.lit("Burst Mode")).otherwise(
        F.concat(rate.cast("string"), F.lit(" rec/s"))
    )


def trunc_int(value: Column) -> Column:
    """Double to int towards zero, saturating at the int range; NaN is 0."""
    bounded = F.least(F.greatest(value, F.lit(float(INT_MIN))), F.lit(float(INT_MAX)))
    return F.when(F.isnan(value), F.lit(0)).otherwise(bounded.cast("int"))


def file_timestamp(file_name: Column) -> Column:
    """The number after the last underscore of a ``.json`` file's stem, NULL if not a number."""
    return F.regexp_extract(file_name, r"_([0-9]+)\.json$", 1).try_cast("bigint")


def compare(value: Column, operator: Column, target: Column) -> Column:
    """Verdict of ``value operator target``; NULL without a value, operator or target."""
    return (
        F.when(value.isNull() | operator.isNull() | target.isNull(), F.lit(None).cast("boolean"))
        .when(operator == ">", value > target)
        .when(operator == ">=", value >= target)
        .when(operator == "<", value < target)
        .when(operator == "<=", value <= target)
        .otherwise(F.raise_error(F.concat(F.lit("unsupported operator: "), operator)))
    )


def short_number(value: Column) -> Column:
    """Six significant digits without trailing zeros (``500``, ``0.8``, ``1e+06``)."""
    padded = F.format_string("%.6g", value)
    stripped = F.regexp_replace(padded, r"\.?0+(e.*)?$", "$1")
    return F.when(F.contains(padded, F.lit(".")), stripped).otherwise(padded)


def target_text(operator: Column, target: Column, unit: Column) -> Column:
    suffix = F.when(F.coalesce(unit, F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit(" "), unit)
    )
    return F.when(operator.isNull() | target.isNull(), F.lit("Reference only")).otherwise(
        F.concat(F.lit("Target "), operator, F.lit(" "), short_number(target), suffix)
    )


def status_text(passed: Column) -> Column:
    return F.when(passed.isNull(), "[INFO]").when(passed, "[PASS]").otherwise("[FAIL]")
