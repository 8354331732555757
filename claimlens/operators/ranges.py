"""Skew-safe range buckets: cut an ordered key at its quantiles.

Equal-width buckets collapse when keys are clustered or one key lies far out.
Quantile bounds follow the data instead, so a bucket holds about
``rows_per_bucket`` rows whatever the keys look like.  The bounds are a list of
``rows / rows_per_bucket`` numbers, which is all that reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

#: Bounds are searched in two levels of at most this many comparisons each.
_FAN = 256


def quantile_bounds(df: DataFrame, key: Column, rows_per_bucket: int) -> list[int]:
    """Ascending distinct values of the integral, non-null ``key``, the first
    being its minimum, that cut ``df`` into buckets of about
    ``rows_per_bucket`` rows.  Every bound is a value that occurs.  Empty for an
    empty ``df``."""
    n = df.count()
    if not n:
        return []
    buckets = max(1, math.ceil(n / rows_per_bucket))
    at = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.min(key).alias("low"), *([F.percentile_approx(key, at, 20 * buckets).alias("cuts")] if at else [])).first()
    return sorted({int(row["low"]), *map(int, row["cuts"] if at else ())})


def range_bucket(key: Column, bounds: list[int]) -> Column:
    """Index of the last bound that is not above ``key`` (0 below the first)."""
    if len(bounds) < 2:
        return F.lit(0)
    if len(bounds) <= _FAN:
        return F.greatest(F.size(F.filter(_longs(bounds), lambda b: b <= key)) - 1, F.lit(0))
    step = math.ceil(math.sqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    outer = F.greatest(F.size(F.filter(_longs([g[0] for g in groups]), lambda b: b <= key)) - 1, F.lit(0))
    inner = F.size(F.filter(F.get(F.array(*[_longs(g) for g in groups]), outer), lambda b: b <= key)) - 1
    return outer * F.lit(step) + F.greatest(inner, F.lit(0))


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])
