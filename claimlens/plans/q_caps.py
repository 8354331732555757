"""Registered query of the caps per category and search."""

from __future__ import annotations

from ..operators import caps
from . import inputs as I
from .registry import query

# The choice row by row: each step carries the groups of the rows taken so far.
_GREEDY = f"""WITH RECURSIVE r AS MATERIALIZED (
  SELECT doc_id, coalesce('v' || lang, 'n') AS c, coalesce('v' || source, 'n') AS s, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS k FROM documents),
walk AS (
  SELECT 0::BIGINT AS k, 0::BIGINT AS doc_id, false AS taken, []::VARCHAR[] AS cs, []::VARCHAR[] AS ss
  UNION ALL
  SELECT k, doc_id, ok, CASE WHEN ok THEN list_append(cs, c) ELSE cs END, CASE WHEN ok THEN list_append(ss, s) ELSE ss END
  FROM (SELECT r.k, r.doc_id, r.c, r.s, w.cs, w.ss,
               len(list_filter(w.cs, lambda x: x = r.c)) < {caps.PER_CATEGORY} AND len(list_filter(w.ss, lambda x: x = r.s)) < {caps.PER_SEARCH} AS ok
        FROM walk w JOIN r ON r.k = w.k + 1))
SELECT d.doc_id, d.lang, d.source FROM documents d JOIN walk w ON w.doc_id = d.doc_id WHERE w.taken"""


@query("frame_caps", _GREEDY)
def frame_caps(spark, sf_dir):
    """Documents by falling length, at most 50 a language and 20 a source."""
    docs = I.load(spark, sf_dir, "documents").selectExpr("doc_id", "lang", "source", "-n_chars AS rank")
    return caps.capped(docs, "lang", "source", ["rank", "doc_id"]).select("doc_id", "lang", "source")
