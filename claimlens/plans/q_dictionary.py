"""Registered queries of the dictionary join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dictionary
from . import inputs as I
from .registry import query

LONGEST = 3


def phrase_list(spark, sf_dir):
    """Fixture list (phrase, name): of each benchmark passage the first token,
    the next two, and the three after; the name is the passage's number."""
    items = I.load(spark, sf_dir, "benchmark").select("item_id", dictionary.phrase_tokens(F.col("text")).alias("t"))
    parts = [F.array_join(F.slice("t", start, size), " ") for start, size in ((1, 1), (2, 2), (4, 3))]
    return items.select(F.explode(F.array(*parts)).alias("phrase"), F.concat(F.lit("n"), F.col("item_id").cast("string")).alias("name"))


_TOKENS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
# All n-grams against the list; matches chosen from left to right by recursion.
_FOUND = f"""WITH RECURSIVE items AS (SELECT item_id, {_TOKENS} AS t FROM benchmark),
parts AS (SELECT 'n' || item_id AS name, list_aggregate(unnest([t[1:1], t[2:3], t[4:6]]), 'string_agg', ' ') AS phrase FROM items),
listed AS MATERIALIZED (SELECT phrase, min(name) AS name FROM parts WHERE phrase <> '' GROUP BY phrase),
docs AS MATERIALIZED (SELECT doc_id, {_TOKENS} AS t FROM documents),
grams AS (SELECT doc_id, i - 1 AS start, n AS size, list_aggregate(t[i:i + n - 1], 'string_agg', ' ') AS phrase
          FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM docs), range(1, {LONGEST + 1}) r(n) WHERE i + n - 1 <= len(t)),
met AS (SELECT doc_id, start, max(size) AS size, arg_max(name, size) AS name, arg_max(phrase, size) AS phrase FROM grams JOIN listed USING (phrase) GROUP BY doc_id, start),
ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS k FROM met),
chosen AS (SELECT doc_id, k, start, size, name, phrase, true AS taken, start + size AS free FROM ordered WHERE k = 1
  UNION ALL SELECT o.doc_id, o.k, o.start, o.size, o.name, o.phrase, o.start >= c.free, CASE WHEN o.start >= c.free THEN o.start + o.size ELSE c.free END
  FROM chosen c JOIN ordered o ON o.doc_id = c.doc_id AND o.k = c.k + 1)"""


@query("dictionary_matches", _FOUND + " SELECT doc_id, start::INT AS start, size::INT AS size, phrase, name FROM chosen WHERE taken")
def dictionary_matches(spark, sf_dir):
    """Phrases of a list table in all documents, leftmost and longest."""
    docs = I.load(spark, sf_dir, "documents")
    return dictionary.matches(docs, "doc_id", "text", phrase_list(spark, sf_dir))


@query("dictionary_warnings", _FOUND + """, warn AS (SELECT 'n' || item_id AS name FROM items WHERE item_id % 5 = 0)
SELECT d.doc_id, coalesce(string_agg(DISTINCT c.name, '|' ORDER BY c.name), '') AS names, coalesce(bool_or(c.name IN (SELECT name FROM warn)), false) AS warned
FROM docs d LEFT JOIN (SELECT * FROM chosen WHERE taken) c USING (doc_id) GROUP BY d.doc_id""")
def dictionary_warnings(spark, sf_dir):
    """Names of a list table per document, and whether one is on
    the warning list (fixture: every fifth passage)."""
    docs = I.load(spark, sf_dir, "documents")
    found = dictionary.names_per_row(docs, "doc_id", "text", phrase_list(spark, sf_dir))
    warnings = I.load(spark, sf_dir, "benchmark").where("item_id % 5 = 0").select(F.concat(F.lit("n"), F.col("item_id").cast("string")).alias("name"))
    warned = dictionary.warned(found, warnings, "doc_id").withColumn("warned", F.lit(True))
    return docs.select("doc_id").join(found, "doc_id", "left").join(warned, "doc_id", "left").select(
        "doc_id", F.coalesce(F.array_join("names", "|"), F.lit("")).alias("names"), F.coalesce("warned", F.lit(False)).alias("warned"))
