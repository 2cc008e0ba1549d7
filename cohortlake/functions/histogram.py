"""Log-linear histogram buckets of non-negative integers, as used for latencies.

A histogram of ``digits`` significant digits keeps the leading ``m`` bits of a value, with
``2**m`` the first power of two not below ``2 * 10**digits``. All values of a bucket share
these bits, so bounds are plain bit operations and any two histograms can be added up. For three
digits there are 2,048 + 1,024 * 52 buckets in the whole 63-bit range: the bound on every
frame grouped by bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def kept_bits(digits: int = 3) -> int:
    return math.ceil(math.log2(2 * 10**digits))


def bucket_width(value: Column, digits: int = 3) -> Column:
    """Number of integers that share the bucket of ``value``, a power of two."""
    dropped = F.greatest(F.length(F.bin(value)) - F.lit(kept_bits(digits)), F.lit(0))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), dropped)


def bucket_low(value: Column, digits: int = 3) -> Column:
    """Smallest value of the bucket."""
    return value - value.bitwiseAND(bucket_width(value, digits) - 1)


def bucket_top(value: Column, digits: int = 3) -> Column:
    """Largest value of the bucket: what the histogram reports for it."""
    return value.bitwiseOR(bucket_width(value, digits) - 1)
