"""Small Column builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def hash32(key: Column, salt: str) -> Column:
    """Reproducible 32-bit hash of a key; any engine with md5 gives the same number."""
    text = F.concat_ws("|", key.cast("string"), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform52(text: Column) -> Column:
    """Reproducible uniform number in [0, 1) with 52 bits, for tables of any size."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def uniform(key: Column, salt: str) -> Column:
    """Reproducible uniform number in [0, 1)."""
    return hash32(key, salt) / F.lit(4294967296.0)


def finite_or_zero(c: str) -> str:
    """SQL text: null, NaN and both infinities of a numeric column become 0."""
    x = f"double(`{c}`)"
    return f"if({x} is null or isnan({x}) or abs({x}) = double('inf'), 0.0d, {x})"


def equal_width_bin(x: Column, low: Column, high: Column, n: int) -> Column:
    """0-based bin among ``n`` equal bins; the last one is closed; a zero range is bin 0."""
    scaled = F.floor(F.try_divide((x - low) * F.lit(n), high - low))
    return F.when(high > low, F.least(scaled, F.lit(n - 1))).otherwise(F.lit(0)).cast("bigint")


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
