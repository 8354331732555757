"""Caps per category and per search at once (D08): the greedy choice in rounds.

A row is taken if, of the rows taken before it, fewer than ``PER_CATEGORY`` have its
category and fewer than ``PER_SEARCH`` its search.  Rows are not decided one by one:
of those still open, a row that is among the first of its category *and* among the
first of its search, as many as each has room for, is taken whatever becomes
of the rows before it; a category or search without room closes its other rows.  The
first open row of all is always taken, so the rounds end.  The first rows of a
group are found with a map-side limit, so a category that holds a third of all rows
sends at most ``PER_CATEGORY`` of them per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .sequence import top_rows_per_group

#: Limits of the page policy.
PER_CATEGORY, PER_SEARCH = 50, 20


def _name(col: str) -> Column:
    """A group's name; null is a group of its own."""
    return F.coalesce(F.concat(F.lit("v"), F.col(col).cast("string")), F.lit("n"))


def capped(df: DataFrame, category_col: str, search_col: str, order_cols, per_category: int = PER_CATEGORY, per_search: int = PER_SEARCH) -> DataFrame:
    """The taken rows of ``df``; rows are in the order of ``order_cols``, nulls
    last, and equal ones in an order fixed when they are read."""
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    order = [F.col(f"_o{i}").asc_nulls_last() for i in range(len(order_cols))] + [F.col("_row")]
    open_ = rows.select("_row", _name(category_col).alias("category"), _name(search_col).alias("search"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])
    taken = rows.select("_row").limit(0).withColumns({"category": F.lit(""), "search": F.lit("")})
    caps = {"category": per_category, "search": per_search}
    if min(caps.values()) <= 0:
        return df.limit(0)
    while True:
        heads = []
        for group, cap in caps.items():
            used = taken.groupBy(group).agg(F.count(F.lit(1)).alias("used"))
            first = top_rows_per_group(open_, [group], order, cap, name="rank", keep_rank=True).join(used, group, "left")
            heads.append(first.where(F.col("rank") + F.coalesce("used", F.lit(0)) <= cap))
        new = cut_lineage(heads[0].select("_row", "category", "search").join(heads[1].select("_row"), "_row"))
        if new.isEmpty():
            break
        taken = cut_lineage(taken.unionByName(new))
        open_ = open_.join(new.select("_row"), "_row", "left_anti")
        for group, cap in caps.items():
            full = taken.groupBy(group).agg(F.count(F.lit(1)).alias("used")).where(F.col("used") >= cap).select(group)
            open_ = open_.join(full, group, "left_anti")
        open_ = cut_lineage(open_)
    return rows.join(taken.select("_row"), "_row", "left_semi").drop("_row")
