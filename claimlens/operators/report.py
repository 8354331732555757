"""Pattern report (R01-R03): hint ids and tokens counted per gate.

One pass: the three array columns become one exploded ``(gate, pattern)``
relation, aggregated with a partial ``HashAggregate``.  The report is ordered
by gate, count descending and first appearance; the aggregated table has one
row per distinct rule id, so ordering it needs no global sort of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import REPORT_GATES

GATE_COLUMNS = {"phi": "phi_hint_ids", "k": "k_hint_ids", "l": "l_tokens"}


def pattern_counts(claims: DataFrame, row_col: str = "row_ord", gates=REPORT_GATES) -> DataFrame:
    """R01 + R02: ``(gate, pattern, count, report_pos)``."""
    per_gate = F.array(*[F.struct(F.lit(label).alias("gate"), F.lit(i).alias("gate_rank"),
                                  F.col(GATE_COLUMNS[key]).alias("ids"))
                         for i, (label, key) in enumerate(gates)])
    g = claims.select(F.col(row_col).alias("_row"), F.explode(per_gate).alias("_g"))
    e = g.select("_row", F.col("_g.gate").alias("gate"), F.col("_g.gate_rank").alias("gate_rank"),
                 F.posexplode("_g.ids").alias("_pos", "pattern"))
    agg = e.groupBy("gate", "gate_rank", "pattern").agg(
        F.count(F.lit(1)).alias("count"), F.min(F.struct("_row", "_pos")).alias("_first"))
    order = Window.orderBy("gate_rank", F.desc("count"), "_first")
    return agg.select("gate", "pattern", "count", (F.row_number().over(order) - 1).alias("report_pos"))


def distinct_patterns(counts: DataFrame, gates=REPORT_GATES) -> DataFrame:
    """Distinct patterns per gate (gates without hits report 0)."""
    g = counts.groupBy("gate").agg(F.countDistinct("pattern").alias("n_patterns"))
    labels = counts.sparkSession.createDataFrame([(lab, i) for i, (lab, _) in enumerate(gates)],
                                                 "gate string, gate_rank int")
    return labels.join(g, "gate", "left").select(
        "gate", "gate_rank", F.coalesce(F.col("n_patterns"), F.lit(0)).cast("long").alias("n_patterns"))
