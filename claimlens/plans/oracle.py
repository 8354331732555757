"""DuckDB oracle SQL for the registered queries.

Each statement re-derives its inputs from the same tables with the same
recipes as ``inputs.py`` and computes the operator independently in SQL.  Rule
lists are rendered from the shared constants so both sides use identical
rules; the semantics are written separately.
"""

from __future__ import annotations

from ..config import (HTML_CLAIM_WORDS, K_HINTS, L_HARD_MIN, L_WEIGHTS, PHI_HINTS)
from . import inputs as I
from .registry import ORACLE

# Python's str.isspace() set, for RE2.
PY_WS = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def lit(s) -> str:
    if s is None:
        return "NULL"
    return "'" + str(s).replace("'", "''") + "'"


def arr(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{PY_WS}+|{PY_WS}+$', '', 'g')"


def any_re(patterns, grouped=True) -> str:
    body = "|".join(f"(?:{p})" for p in patterns) if grouped else "|".join(patterns)
    return lit("(?i)" + body)


def ids_expr(text: str, rules) -> str:
    parts = ", ".join(f"CASE WHEN regexp_matches({text}, {any_re(p)}) THEN {lit(h)} END" for h, p in rules)
    return f"concat_ws('|', {parts})"


def ids_json(text: str, rules) -> str:
    parts = ", ".join(f"CASE WHEN regexp_matches({text}, {any_re(p)}) THEN {lit(chr(34) + h + chr(34))} END"
                      for h, p in rules)
    return f"'[' || concat_ws(', ', {parts}) || ']'"


def tokens_expr(text: str, sep="|", quote=False) -> str:
    q = (lambda t: lit('"' + t + '"')) if quote else lit
    parts = ", ".join(f"CASE WHEN contains(lower({text}), {lit(t.lower())}) THEN {q(t)} END" for t, _ in L_WEIGHTS)
    return f"concat_ws({lit(sep)}, {parts})"


def score_expr(text: str) -> str:
    return "(" + " + ".join(f"CASE WHEN contains(lower({text}), {lit(t.lower())}) THEN {w} ELSE 0 END"
                            for t, w in L_WEIGHTS) + ")"


def gate_expr(text: str) -> str:
    k = " OR ".join(f"regexp_matches({text}, {any_re(p)})" for _, p in K_HINTS)
    phi = " OR ".join(f"regexp_matches({text}, {any_re(p)})" for _, p in PHI_HINTS)
    s = score_expr(text)
    return (f"CASE WHEN {k} THEN 'k_candidate' WHEN {phi} THEN 'phi_candidate' "
            f"WHEN {s} >= {L_HARD_MIN} THEN 'l_hard' WHEN {s} > 0 THEN 'l_soft' ELSE 'none' END")


SECTIONS_CTE = f"""lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS sec_ord,
         unnest(string_split(text, chr(10))) AS line FROM documents),
sections AS (
  SELECT doc_id, sec_ord, {strip('line')} AS text FROM lines WHERE {strip('line')} <> ''),
pieces AS (
  SELECT doc_id, sec_ord, generate_subscripts(string_split_regex(text, '[.!?]+'), 1) - 1 AS sent_ord,
         unnest(string_split_regex(text, '[.!?]+')) AS piece FROM sections),
sents AS (SELECT doc_id, sec_ord, sent_ord, {strip('piece')} AS claim_text FROM pieces)"""


FX_CTE = f"""{SECTIONS_CTE},
fxs AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec_ord, sent_ord) - 1 AS pos FROM sents
  WHERE regexp_matches(claim_text, {any_re(I.DENSE_LEXICON, grouped=False)}) AND length(claim_text) >= 10),
fxd AS (
  SELECT s.doc_id, s.doc_id * 20 + s.pos AS claim_ord, sha256(d.text) AS page_hash,
         s.claim_text || ' ' || ({arr(I.FX_TEMPLATES)})[(s.doc_id + s.pos) % {len(I.FX_TEMPLATES)} + 1] AS claim_text
  FROM fxs s JOIN documents d ON d.doc_id = s.doc_id WHERE s.pos < 20),
fx AS (
  SELECT claim_ord, printf('K%09d', doc_id // 5) AS product_key, claim_text,
         CASE claim_ord % 4 WHEN 0 THEN 0.9::DOUBLE WHEN 1 THEN 0.6::DOUBLE WHEN 2 THEN 0.7::DOUBLE
              ELSE 0.75::DOUBLE END AS confidence,
         CASE WHEN claim_ord % 4 = 2 THEN 'image' ELSE 'html' END AS origin,
         CASE WHEN (doc_id // 5) % 4 = 0 THEN 'T' ELSE 'R' END AS cohort, page_hash
  FROM fxd)"""

# Claims of the raw records: record = (product, origin), ordered by first claim.
FXC_CTE = FX_CTE + """,
fxr AS (
  SELECT *, min(claim_ord) OVER (PARTITION BY product_key, origin) AS rec_ord,
         arg_min(page_hash, claim_ord) OVER (PARTITION BY product_key, origin) AS rec_hash
  FROM fx),
fxc AS (
  SELECT *, row_number() OVER (ORDER BY rec_ord, claim_ord) - 1 AS claim_seq,
         row_number() OVER (PARTITION BY rec_ord ORDER BY claim_ord) - 1 AS claim_pos,
         CASE claim_ord % 3 WHEN 1 THEN 'safety' ELSE 'efficacy' END AS claim_type,
         regexp_extract(claim_text, '([0-9]+)', 1) AS quant_value,
         CASE WHEN claim_ord % 3 = 1 THEN 'mg' ELSE '' END AS quant_unit,
         CASE WHEN claim_ord % 5 = 0 THEN 'placebo' ELSE '' END AS comparator
  FROM fxr)"""

def _sentence_sql(words) -> str:
    return f"""WITH {SECTIONS_CTE},
kept AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec_ord, sent_ord) AS rn FROM sents
  WHERE regexp_matches(claim_text, {any_re(words, grouped=False)}) AND length(claim_text) >= 10)
SELECT doc_id, rn - 1 AS claim_pos, claim_text, regexp_matches(claim_text, '[0-9]') AS has_numeric_quantifier
FROM kept WHERE rn <= 20"""


ORACLE["sentence_claims"] = _sentence_sql(HTML_CLAIM_WORDS)
ORACLE["sentence_claims_dense"] = _sentence_sql(I.DENSE_LEXICON)
ORACLE["section_claims_dense"] = _sentence_sql(I.DENSE_LEXICON)

ORACLE["doc_claim_rollup"] = f"""WITH {SECTIONS_CTE},
kept AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec_ord, sent_ord) AS rn FROM sents
  WHERE regexp_matches(claim_text, {any_re(HTML_CLAIM_WORDS, grouped=False)}) AND length(claim_text) >= 10)
SELECT doc_id, count(*) AS n_claims,
       bool_or({ids_expr('claim_text', PHI_HINTS)} <> '') AS phi_any_candidate,
       bool_or({ids_expr('claim_text', K_HINTS)} <> '') AS k_any_candidate,
       max({score_expr('claim_text')})::INTEGER AS l_max_token_score,
       sum(CASE WHEN regexp_matches(claim_text, '[0-9]') THEN 1 ELSE 0 END)::BIGINT AS n_numeric
FROM kept WHERE rn <= 20 GROUP BY doc_id"""

ORACLE["hint_phi"] = f"WITH {FX_CTE} SELECT claim_ord, {ids_expr('claim_text', PHI_HINTS)} AS phi_hint_ids FROM fx"
ORACLE["hint_k"] = (f"WITH {FX_CTE} SELECT claim_ord, {ids_expr('claim_text || ' + lit(' '), K_HINTS)} AS k_hint_ids "
                    f"FROM fx")
ORACLE["hint_l"] = (f"WITH {FX_CTE} SELECT claim_ord, {tokens_expr('claim_text')} AS l_tokens, "
                    f"{score_expr('claim_text')}::INTEGER AS l_token_score FROM fx")
ORACLE["gate_hint"] = f"WITH {FX_CTE} SELECT claim_ord, {gate_expr('claim_text')} AS gate_hint FROM fx"

ORACLE["claims_normalized"] = f"""WITH {FXC_CTE}
SELECT printf('%s_c%04d', product_key, claim_seq) AS claim_id, product_key AS asin,
       claim_text AS claim_text_verbatim, claim_type, quant_value, quant_unit, comparator, origin AS source,
       CASE WHEN origin = 'image' THEN '[[0, 0, 10, 10]]' END AS ocr_bbox,
       'gemini-2.0-flash-exp' AS extraction_model, 'v2025-11-12' AS extraction_version,
       0.0::DOUBLE AS extraction_temperature, sha256(claim_text) AS claim_sha256, rec_hash AS page_sha256,
       regexp_matches(claim_text, '[0-9]') AS has_numeric_quantifier,
       {ids_json('claim_text', PHI_HINTS)} AS phi_hint_ids,
       {ids_json('claim_text || ' + lit(' '), K_HINTS)} AS k_hint_ids,
       '[' || {tokens_expr('claim_text', sep=', ', quote=True)} || ']' AS l_tokens,
       {score_expr('claim_text')}::INTEGER AS l_token_score, confidence AS extract_confidence,
       {gate_expr('claim_text')} AS gate_hint, confidence < 0.8 AS review_needed
FROM fxc"""

ORACLE["claim_sequence"] = f"""WITH {FXC_CTE}
SELECT printf('%s_c%04d', product_key, claim_seq) AS claim_id, claim_seq, rec_ord, claim_pos FROM fxc"""

ORACLE["product_rollup"] = f"""WITH {FXC_CTE},
meta AS (
  SELECT printf('K%09d', doc_id // 5) AS asin,
         arg_max(CASE WHEN (doc_id // 5) % 4 = 0 THEN 'T' ELSE 'R' END, doc_id) AS cohort,
         arg_max(CASE WHEN (doc_id // 5) % 4 = 0 THEN 'keyword' ELSE 'random' END, doc_id) AS method,
         arg_max(upper(substr(lang, 1, 1)) || lower(substr(lang, 2)), doc_id) AS category_hint
  FROM documents WHERE lang <> 'de' GROUP BY 1),
prod AS (
  SELECT product_key AS asin, arg_min(rec_hash, rec_ord) AS product_sha256,
         bool_or({ids_expr('claim_text', PHI_HINTS)} <> '') AS phi_any_candidate,
         bool_or({ids_expr('claim_text || ' + lit(' '), K_HINTS)} <> '') AS k_any_candidate,
         max({score_expr('claim_text')})::INTEGER AS l_max_token_score
  FROM fxc GROUP BY 1),
risk AS (
  SELECT asin, string_agg(DISTINCT k, '|' ORDER BY k) AS risk_hits FROM (
    SELECT product_key AS asin, unnest(string_split({ids_expr('claim_text || ' + lit(' '), K_HINTS)}, '|')) AS k
    FROM fxc) WHERE k <> '' GROUP BY 1)
SELECT p.asin, coalesce(m.category_hint, '') AS category_path, coalesce(m.cohort, 'R') AS sampling_cohort,
       coalesce(m.method, 'random') AS selection_method,
       CASE WHEN m.cohort = 'R' THEN 1.0::DOUBLE END AS sampling_weight, p.product_sha256,
       coalesce(r.risk_hits, '') AS risk_hits, p.phi_any_candidate, p.k_any_candidate, p.l_max_token_score
FROM prod p LEFT JOIN meta m ON p.asin = m.asin LEFT JOIN risk r ON p.asin = r.asin"""


def oracle_sql() -> dict[str, str]:
    from .queries import _load_all
    _load_all()
    return dict(ORACLE)
