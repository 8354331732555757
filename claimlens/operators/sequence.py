"""Exact row ordinals without a one-task window.

``Window.orderBy(x)`` with no partition moves every row into one task, and a
window partitioned by a few hot groups (strata) does the same per group.  The
ordinal here is computed in two levels:

1. the order key is cut at its quantiles per group, so that clustered keys and
   outliers fill the buckets evenly;
2. per-bucket sums are prefix-summed on that small table (at most ``buckets``
   rows per group), joined back, and the rows are numbered *within* their bucket.

Without groups the cuts and sums are fewer than ``buckets`` numbers each.  They
are read from a checkpoint of (key, weight) alone and stand in the plan as
literals, so the table itself is derived once more and joined with nothing.

Each bucket is one window partition, so a hot group is spread over many tasks.
No row is lost: a null order key comes last, and group columns are compared
null-safely.  Rows of one equal key share a bucket.  The result is a function
of the data, so recomputing a lost partition gives the same numbers.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

DEFAULT_BUCKETS = 256
#: Cuts per step of the two-level search for a row's bucket.
_STEP = 16
_LAST = (1 << 63) - 1


def _null_safe_join(left: DataFrame, right: DataFrame, cols) -> DataFrame:
    """Inner join on ``cols``, where null equals null; keeps left's columns and
    what right has besides ``cols``."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    on = [left[c].eqNullSafe(right[f"_r_{c}"]) for c in cols]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(right, cond).drop(*[f"_r_{c}" for c in cols])


def _quantiles(buckets: int) -> Column:
    at = [i / buckets for i in range(1, buckets)]
    return F.array_distinct(F.percentile_approx("_key", at, 10 * buckets))


def _bucket(cuts: Column, coarse: Column) -> Column:
    """How many of the ascending ``cuts`` are not above ``_key``; ``coarse`` has
    every ``_STEP``-th of them."""
    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda c: c <= F.col("_key")))

    step = below(coarse)
    return F.when(step == 0, 0).otherwise((step - 1) * _STEP + below(F.slice(cuts, F.greatest((step - 1) * _STEP + 1, F.lit(1)), _STEP)))


def _key(order_col: str) -> Column:
    return F.coalesce(F.col(order_col).cast("long"), F.lit(_LAST))


def _cuts(keyed: DataFrame, buckets: int) -> list[int]:
    return (keyed.agg(_quantiles(buckets).alias("cuts")).first()["cuts"] or []) if buckets > 1 else []


def _literal_bucket(cuts: list[int]) -> Column:
    return _bucket(F.lit(cuts), F.lit(cuts[::_STEP])) if cuts else F.lit(0)


def with_bucket(df: DataFrame, order_col: str, by=(), buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Add ``_key`` (the order key, null last) and ``_bucket`` (how many of the
    group's quantiles are not above it)."""
    by = list(by)
    keyed = df.withColumn("_key", _key(order_col))
    if buckets < 2:
        return keyed.withColumn("_bucket", F.lit(0))
    if not by:
        return keyed.withColumn("_bucket", _literal_bucket(_cuts(keyed, buckets)))
    stats = keyed.groupBy(*by).agg(_quantiles(buckets).alias("_cuts"))
    coarse = F.transform(F.sequence(F.lit(0), F.size("_cuts") - 1, F.lit(_STEP)), lambda i: F.get(F.col("_cuts"), i))
    stats = stats.withColumn("_coarse", coarse)
    keyed = _null_safe_join(keyed, stats, by)
    return keyed.withColumn("_bucket", _bucket(F.col("_cuts"), F.col("_coarse"))).drop("_cuts", "_coarse")


def _with_offsets(df: DataFrame, order_col: str, w: Column, buckets: int) -> DataFrame:
    """Add ``_key``, ``_bucket`` and ``_boff``, the weight of all buckets below."""
    slim = cut_lineage(df.select(_key(order_col).alias("_key"), w.alias("_w")))
    bucket = _literal_bucket(_cuts(slim, buckets))
    sums = {r["_bucket"]: r["n"] for r in slim.groupBy(bucket.alias("_bucket")).agg(F.sum("_w").alias("n")).collect()}     # at most ``buckets``
    offsets = [0, *accumulate(sums.get(i, 0) for i in range(max(sums, default=0)))]
    return df.withColumn("_key", _key(order_col)).withColumn("_bucket", bucket).withColumn("_boff", F.get(F.lit(offsets).cast("array<bigint>"), F.col("_bucket")))


def ordinal(df: DataFrame, order_col: str, by=(), weight: str | None = None, name: str = "ordinal",
            tiebreak=(), buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Add ``name`` = exclusive prefix sum of ``weight`` (1 per row by default;
    a null weight counts 0) in ``order_col`` order within each ``by`` group;
    with the default weight that is ``row_number() - 1``.  ``order_col`` is
    integral, nulls last; equal keys are ordered by ``tiebreak`` columns."""
    by = list(by)
    w = F.lit(1).cast("long") if weight is None else F.coalesce(F.col(weight).cast("long"), F.lit(0))
    if by:
        keyed = with_bucket(df, order_col, by, buckets)
        counts = keyed.groupBy(*by, "_bucket").agg(F.sum(w).alias("_bsum"))
        before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_bsum").over(before), F.lit(0)).cast("long").alias("_boff"))
        keyed = _null_safe_join(keyed, offsets, [*by, "_bucket"])
    else:
        keyed = _with_offsets(df, order_col, w, buckets)
    inner = Window.partitionBy(*by, "_bucket").orderBy("_key", F.col(order_col).isNull(), *[F.col(c) for c in tiebreak])
    if weight is None:
        local = (F.row_number().over(inner) - 1).cast("long")
    else:
        local = F.coalesce(F.sum(w).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return keyed.withColumn(name, (F.col("_boff") + local).cast("long")).drop("_bucket", "_boff", "_key")


def first_n(df: DataFrame, order_col: str, n, by=(), tiebreak=(), name: str = "ordinal",
            keep_ordinal: bool = False) -> DataFrame:
    """Rows whose 0-based ordinal within ``by`` is below ``n`` (an int, or a
    column name holding a per-group quota); the same at every ``n``.  Limits
    that are a fixed feature can use ``top_rows_per_group``."""
    out = ordinal(df, order_col, by=by, name=name, tiebreak=tiebreak)
    limit = F.col(n) if isinstance(n, str) else F.lit(int(n))
    out = out.where(F.col(name) < limit)
    return out if keep_ordinal else out.drop(name)


def top_rows_per_group(df: DataFrame, by, order_cols, n: int, name: str = "_rn",
                       keep_rank: bool = False) -> DataFrame:
    """``row_number() <= n`` per group for a small literal ``n`` (planned with a
    map-side ``WindowGroupLimit``, so a hot group sends at most ``n`` rows per
    input partition through the shuffle)."""
    w = Window.partitionBy(*by).orderBy(*order_cols)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if keep_rank else out.drop(name)
