"""Post-stratification weights.

weight = round(target share / observed share, 4) per stratum of the R cohort;
a stratum the plan does not list gets the share ``1 / len(plan)``.  The
observed counts are a partial aggregation (one row per stratum), the shares a
window over that small table, and the weights go back to the rows through a
join on the stratum (broadcast by AQE when small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .normalize import latest_per_key


def stratum_weights(frame: DataFrame, plan: DataFrame, cohort_col: str = "cohort",
                    stratum_col: str = "stratum", n_plan_strata: int | None = None) -> DataFrame:
    """``(stratum, n, total, target, weight)`` for the R cohort.
    ``plan`` = ``(stratum, allocation)`` (plan-sized)."""
    r = frame.where(F.col(cohort_col) == "R")
    counts = r.groupBy(F.col(stratum_col).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy()))   # one row per stratum
    n_plan = n_plan_strata if n_plan_strata is not None else plan.count()
    default = 1.0 / n_plan if n_plan else None
    p = plan.select("stratum", F.col("allocation").cast("double").alias("allocation"))
    w = counts.join(p, "stratum", "left")
    target = F.coalesce(F.col("allocation"), F.lit(default).cast("double"))
    share = F.col("n") / F.col("total")
    return w.select("stratum", "n", "total", target.alias("target"), "allocation",
                    F.round(F.when(share > 0, target / share).otherwise(F.lit(1.0)), 4).alias("weight"))


def row_weights(frame: DataFrame, weights: DataFrame, key_col: str = "key", cohort_col: str = "cohort",
                stratum_col: str = "stratum") -> DataFrame:
    """Per-row weight of every R row (``key``, ``weight``); a null stratum is a
    stratum of its own."""
    r = frame.where(F.col(cohort_col) == "R").select(key_col, F.col(stratum_col).alias("stratum"))
    w = weights.select(F.col("stratum").alias("_stratum"), "weight")
    return r.join(w, F.col("stratum").eqNullSafe(F.col("_stratum"))).select(key_col, "weight")


def apply_weights(table: DataFrame, row_w: DataFrame, key_col: str = "key", weight_col: str = "sampling_weight",
                  order_col: str | None = None) -> DataFrame:
    """Write weights back by key; any row with that key gets it (T rows
    too if the key is in R); with duplicate R keys the last one wins."""
    w = row_w
    if order_col is not None:
        w = latest_per_key(row_w, key_col, order_col)
    w = w.select(key_col, F.col("weight").alias("_w"))   # keys must be unique unless order_col is given
    out = table.join(w, key_col, "left")
    return out.withColumn(weight_col, F.coalesce(F.col("_w"), F.col(weight_col))).drop("_w")


def stratum_report(weights: DataFrame) -> DataFrame:
    """Count, actual %, target % (0 if the plan lacks the stratum) and the
    mean weight per stratum (all rows of a stratum share one weight)."""
    return weights.select(
        "stratum", F.col("n").alias("n_samples"),
        F.round(F.col("n") / F.col("total") * 100, 1).alias("actual_pct"),
        F.round(F.coalesce(F.col("allocation"), F.lit(0.0)) * 100, 1).alias("target_pct"),
        F.round(F.col("weight"), 3).alias("avg_weight"))
