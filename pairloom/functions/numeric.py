"""Small number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ceil_div(a: Column, b: Column | int) -> Column:
    """Least whole number that is not below a / b, for a >= 0 and b > 0."""
    b = F.lit(b) if isinstance(b, int) else b
    return F.floor((a + b - 1) / b).cast("bigint")


def is_power_of_two(n: Column) -> Column:
    """True for 1, 2, 4, ..; false for others; null for null."""
    return (n > 0) & (n.bitwiseAND(n - 1) == 0)


def percent_reduction(baseline: Column, improved: Column) -> Column:
    """How much smaller ``improved`` is, in percent; 0 if the baseline is not positive."""
    return F.when(baseline > 0, (1 - improved / baseline) * 100).otherwise(F.lit(0.0))


def per_second(count: Column, seconds: Column) -> Column:
    """Throughput; 0 if no time passed."""
    return F.when(seconds > 0, count / seconds).otherwise(F.lit(0.0))
