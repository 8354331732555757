"""Registered queries of claim classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify
from . import inputs as I
from .oracle import FX_CTE, arr, lit
from .registry import query


def _rule(rules, default: str) -> str:
    whens = " ".join(f"WHEN list_has_any(t, {arr(words)}) THEN {lit(name)}" for name, words in rules)
    return f"CASE {whens} ELSE {lit(default)} END"


def _classes(source: str, key: str) -> str:
    """Tokens as rows; numbers meet units, and the quantifier meets comparisons,
    by joins on the claim.  ``source`` is a relation (key, text)."""
    return f"""
tok AS MATERIALIZED (SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[0-9]+(?:[.,][0-9]+)*|%|[\\p{{L}}]+') AS t FROM {source}),
word AS MATERIALIZED (SELECT {key}, unnest(t) AS x, generate_subscripts(t, 1) AS i FROM tok),
num AS (SELECT * FROM word WHERE regexp_matches(x, '^[0-9]')),
unit AS (SELECT * FROM word WHERE list_contains({arr(classify.UNITS)}, x)),
met AS (SELECT n.{key}, n.i, n.x, u.i AS pos, u.x AS unit, abs(n.i - u.i) AS d FROM num n LEFT JOIN unit u ON u.{key} = n.{key} AND abs(n.i - u.i) <= {classify.REACH}),
quant AS (SELECT {key}, i, x AS quant_value, coalesce(unit, '') AS quant_unit FROM met
          QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY d NULLS LAST, CASE WHEN pos > i THEN 0 ELSE 1 END, i) = 1),
cmp AS (SELECT w.{key}, w.i, w.x AS a, coalesce(t.t[w.i + 1], '') AS b, coalesce(t.t[w.i + 2], '') AS c FROM word w JOIN tok t USING ({key})
        WHERE w.x IN ('vs', 'versus', 'than') OR (w.x = 'compared' AND t.t[w.i + 1] IN ('to', 'with'))),
near AS (SELECT c.{key}, trim(CASE WHEN a = 'compared' THEN a || ' ' || b || ' ' || c.c ELSE a || ' ' || b END) AS comparator
         FROM cmp c LEFT JOIN quant q ON q.{key} = c.{key} QUALIFY row_number() OVER (PARTITION BY c.{key} ORDER BY coalesce(abs(c.i - q.i), c.i), c.i) = 1)
SELECT t.{key}, {_rule(classify.TYPE_RULES, 'efficacy')} AS claim_type, {_rule(classify.OUTCOME_RULES, 'other')} AS implied_outcome,
       CASE WHEN q.{key} IS NULL THEN '' WHEN quant_unit IN ('', '%') THEN quant_value || quant_unit ELSE quant_value || ' ' || quant_unit END AS quantifier,
       q.{key} IS NOT NULL AS has_numeric_quantifier, coalesce(quant_value, '') AS quant_value, coalesce(quant_unit, '') AS quant_unit,
       coalesce(comparator, '') AS comparator
FROM tok t LEFT JOIN quant q USING ({key}) LEFT JOIN near n USING ({key})"""


@query("claim_classes", f"WITH {FX_CTE}, named AS (SELECT claim_ord, claim_text AS text FROM fx),{_classes('named', 'claim_ord')}")
def claim_classes(spark, sf_dir):
    """D10 over the claims derived from all documents."""
    fx = I.derived_claims(I.load(spark, sf_dir, "documents"))
    return classify.classify_claims(fx).select("claim_ord", *classify.COLUMNS)


@query("document_classes", f"WITH {_classes('documents', 'doc_id')}")
def document_classes(spark, sf_dir):
    """D10 over whole documents, each read as one claim: many numbers and units
    compete in a row."""
    docs = I.load(spark, sf_dir, "documents")
    return classify.classify_claims(docs, "text").select("doc_id", *classify.COLUMNS)


@query("class_report", f"""WITH {FX_CTE}, named AS (SELECT claim_ord, claim_text AS text FROM fx),
made AS (WITH {_classes('named', 'claim_ord')})
SELECT claim_type, implied_outcome, quant_unit, count(*) AS n_claims, count(*) FILTER (WHERE has_numeric_quantifier) AS n_numeric,
       count(*) FILTER (WHERE comparator <> '') AS n_compared FROM made GROUP BY 1, 2, 3""")
def class_report(spark, sf_dir):
    """Claims by type, outcome and unit (partial aggregates, then one small shuffle)."""
    made = classify.classify_claims(I.derived_claims(I.load(spark, sf_dir, "documents")))
    return made.groupBy("claim_type", "implied_outcome", "quant_unit").agg(
        F.count(F.lit(1)).alias("n_claims"), F.count_if("has_numeric_quantifier").alias("n_numeric"), F.count_if(F.col("comparator") != "").alias("n_compared"))
