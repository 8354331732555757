"""Sampling frame.

The plan (strata / nodes) is config-sized: it is carried as a small DataFrame
or a driver-side list.  Search results are a table
``(group, rank, link)``; the harvests are joins, partial aggregations and
exact ordinals over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import PRODUCT_ID_PATTERNS, PRODUCT_URL_PREFIX, RESULTS_PER_KEYWORD
from ..session import cut_lineage
from .sequence import first_n, top_rows_per_group

SLOTS_PER_CHUNK = 1 << 16


def stratum_quota(target_n, allocation: Column) -> Column:
    """``int(target_n * allocation)`` in DOUBLE arithmetic, truncated
    (700 x 0.35 = 244.999... -> 244; a DECIMAL product would give 245)."""
    target = target_n if isinstance(target_n, Column) else F.lit(target_n)
    return (target.cast("double") * allocation.cast("double")).cast("int")


def node_quota(target_n, n_nodes) -> Column:
    """``max(1, target_n // n_nodes)``."""
    t = target_n if isinstance(target_n, Column) else F.lit(target_n)
    n = n_nodes if isinstance(n_nodes, Column) else F.lit(n_nodes)
    return F.greatest(F.lit(1).cast("long"), F.floor(t / n).cast("long"))


def slot_id(prefix: str, name: Column, i: Column) -> Column:
    """P02/P03 placeholder id: prefix + first three letters upper-cased + 5-digit index."""
    return F.format_string(prefix + "%s%05d", F.upper(F.substring(name, 1, 3)), i)


def product_url(product_id: Column) -> Column:
    """Canonical product URL."""
    return F.concat(F.lit(PRODUCT_URL_PREFIX), product_id)


def expand_slots(spark: SparkSession, quotas: DataFrame, prefix: str = "R") -> DataFrame:
    """One placeholder row per slot of each stratum.

    ``quotas`` = ``(stratum, stratum_ord, quota)`` is plan-sized.  A quota is cut
    into chunks, which are dealt over the tasks and expanded there."""
    q = quotas.where(F.col("quota") > 0).withColumn("quota", F.col("quota").cast("long"))
    chunks = q.select("stratum", "stratum_ord", "quota", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1, F.lit(SLOTS_PER_CHUNK).cast("long"))).alias("_from"))
    chunks = chunks.repartition("stratum_ord", "_from")
    to = F.least(F.col("quota"), F.col("_from") + SLOTS_PER_CHUNK) - 1
    j = chunks.select("stratum", "stratum_ord", F.explode(F.sequence("_from", to)).alias("slot"))
    i = F.col("slot")
    asin = slot_id(prefix, F.col("stratum"), i)
    return j.select(asin.alias("asin"), product_url(asin).alias("url"), F.lit(prefix).alias("cohort"),
                    F.lit("placeholder").alias("method"), F.col("stratum").alias("category_hint"),
                    F.col("stratum"), "stratum_ord", i.alias("slot_ord"))


def expand_keyword_slots(keywords: DataFrame, per_node: int = 5, prefix: str = "T") -> DataFrame:
    """The first ``per_node`` keywords of each node (by ``keyword_ord``),
    one slot each (``row_number <= 5``: a map-side WindowGroupLimit)."""
    k = top_rows_per_group(keywords, ["node"], [F.col("keyword_ord")], per_node, name="_i", keep_rank=True)
    i = (F.col("_i") - 1).cast("long")
    asin = slot_id(prefix, F.col("node"), i)
    return k.select(asin.alias("asin"), product_url(asin).alias("url"), F.lit(prefix).alias("cohort"),
                    F.lit("placeholder").alias("method"), F.col("node").alias("category_hint"),
                    F.col("node").alias("stratum"), "keyword", i.alias("slot_ord"))


def extract_product_id(url: Column, patterns=PRODUCT_ID_PATTERNS, missing: str | None = "") -> Column:
    """First pattern (in order) that matches gives the id; miss -> ''."""
    tries = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*tries, F.lit(missing).cast("string"))


def harvest_simple(results: DataFrame, group_col: str = "stratum") -> DataFrame:
    """Dedupe within one query only (ids may repeat across strata); no
    trimming to the quota.  ``groupBy`` keeps the combine map-side."""
    r = results.where(F.col("asin") != "")
    return r.groupBy(group_col, "asin").agg(F.min("rank").alias("rank"))


def harvest_greedy(candidates: DataFrame, groups, group_col: str = "stratum", order_col: str = "rank",
                   checkpoint: bool = True) -> DataFrame:
    """Groups in plan order; inside a group, candidates in order; an
    id is kept if non-empty and not taken by any earlier kept row; stop at the
    group's quota.  A result cut by one group's quota stays available to later
    groups.

    ``groups`` is the plan-sized list ``[(name, quota), ...]``.  Each step is a
    left-anti join against the ids taken so far, a partial aggregation (first
    occurrence per id) and an exact ordinal (``first_n``); lineage is cut after
    each group so the plan does not grow with the number of groups."""
    picked_parts = []
    taken = None
    cand = candidates.where(F.col("asin") != "")
    cols = [c for c in candidates.columns if c not in ("asin", order_col)]
    for g_ord, (name, quota) in enumerate(groups):
        c = cand.where(F.col(group_col) == F.lit(name))
        if taken is not None:
            c = c.join(taken, "asin", "left_anti")
        first = c.groupBy("asin").agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("_r"),
                                      F.min(order_col).alias(order_col))
        first = first.select("asin", order_col, *[F.col("_r")[k].alias(k) for k in cols])
        picked = first_n(first, order_col, int(quota), name="pick_ord", keep_ordinal=True, tiebreak=["asin"]) \
            .withColumn("group_ord", F.lit(g_ord))
        if checkpoint:
            picked = cut_lineage(picked)
        picked_parts.append(picked)
        ids = picked.select("asin")
        taken = ids if taken is None else taken.unionByName(ids)
    if not picked_parts:                        # an empty plan picks nothing
        return cand.select("asin", order_col, *cols, F.lit(0).cast("long").alias("pick_ord"), F.lit(0).alias("group_ord")).limit(0)
    out = picked_parts[0]
    for p in picked_parts[1:]:
        out = out.unionByName(p)
    return out


def cap_per_keyword(results: DataFrame, n: int = RESULTS_PER_KEYWORD) -> DataFrame:
    """At most ``n`` results per (node, keyword) request, by rank."""
    return top_rows_per_group(results, ["node", "keyword"], [F.col("rank")], n)


def keyword_order(keyword_ord: Column, rank: Column) -> Column:
    """P09 order (keyword_ord, rank) as one long (rank < 2^40); ``ordinal`` cuts
    it at its quantiles, so the gaps between keywords cost nothing."""
    return keyword_ord.cast("long") * F.lit(1 << 40) + rank.cast("long")


def frame_union(r_rows: DataFrame, t_rows: DataFrame) -> DataFrame:
    """P10: R rows then T rows (UNION ALL, no distinct)."""
    return r_rows.withColumn("cohort_ord", F.lit(0)).unionByName(
        t_rows.withColumn("cohort_ord", F.lit(1)), allowMissingColumns=True)


def frame_head(frame: DataFrame, n: int) -> DataFrame:
    """Ordered head (R rows first).  ``n`` is the sample size; Spark plans
    ``TakeOrderedAndProject`` (per-partition top-n, then a merge of n x P rows)."""
    return frame.orderBy("cohort_ord", "group_ord", "pick_ord").limit(int(n))


def cap_per_group(df: DataFrame, group_cols, order_cols, cap: int) -> DataFrame:
    """D08 (extension): per-category / per-search caps (``row_number <= cap``)."""
    return top_rows_per_group(df, list(group_cols), order_cols, cap)
