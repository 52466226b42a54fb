"""Draws that are pure functions of (seed, key): repeatable on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = float(2**32)


def uniform(seed: int | str, *key: Column) -> Column:
    """A number in [0, 1) from the md5 of ``seed:key``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(_SPAN)


def uniform_int(u: Column, lo: Column, hi: Column) -> Column:
    """An int in [lo, hi)."""
    return (lo + F.floor(u * (hi - lo))).cast("int")


def triangular_int(u: Column, left: Column, mode: Column, right: Column) -> Column:
    """A triangular draw cut to an int, by the inverse distribution function."""
    left, mode, right = (c.cast("double") for c in (left, mode, right))
    width = right - left
    rising = left + F.sqrt(u * width * (mode - left))
    falling = right - F.sqrt((F.lit(1.0) - u) * width * (right - mode))
    return F.when(u < (mode - left) / width, rising).otherwise(falling).cast("int")
