"""Claim-extraction queries (X08-X19) and their oracle SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..config import HTML_CLAIM_WORDS, OCR_CLAIM_WORDS, ExtractionPolicy
from ..operators import extract, html, pages
from . import inputs as I
from .oracle import FX_CTE, SECTIONS_CTE, any_re, arr, lit, strip
from .registry import query

_RESP_CTE = f"""r AS (SELECT doc_id, replace(({arr(I.RESPONSE_BODIES)})[doc_id % {len(I.RESPONSE_BODIES)} + 1], '@',
             regexp_replace(coalesce(text, ''), {lit(I.JSON_UNSAFE)}, ' ', 'g')) AS body FROM documents),
v AS (SELECT doc_id, body FROM r
      WHERE body IS NOT NULL AND json_valid(body) AND json_type(body::JSON) = 'ARRAY'),
e AS (SELECT doc_id, generate_subscripts(json_extract(body, '$[*]'), 1) - 1 AS claim_pos,
             unnest(json_extract(body, '$[*]')) AS el FROM v),
bad AS (SELECT DISTINCT doc_id FROM e WHERE json_type(el) <> 'OBJECT'),
valid AS (SELECT doc_id FROM v WHERE doc_id NOT IN (SELECT doc_id FROM bad)),
ok AS (SELECT * FROM e WHERE doc_id IN (SELECT doc_id FROM valid))"""


def _get(key, default):
    return f"CASE WHEN list_contains(json_keys(el), {lit(key)}) THEN el->>{lit(key)} ELSE {lit(default)} END"


@query("response_claims", f"""WITH {_RESP_CTE}
SELECT doc_id, claim_pos::INTEGER AS claim_pos, {_get('text', '')} AS claim_text,
       {_get('claim_type', 'unknown')} AS claim_type, {_get('implied_outcome', '')} AS implied_outcome,
       {_get('quantifier', '')} AS quantifier,
       CASE WHEN list_contains(json_keys(el), 'has_numeric_quantifier')
            THEN TRY_CAST(el->>'has_numeric_quantifier' AS BOOLEAN) ELSE false END AS has_numeric_quantifier
FROM ok""")
def response_claims(spark, sf_dir):
    """Claims of valid model responses with absent-key defaults (an
    absent key gets the default, a JSON null stays null)."""
    resp = I.model_responses(I.load(spark, sf_dir, "documents"))
    c = extract.response_claims(resp, ["doc_id"]).where(F.col("claim_pos").isNotNull())
    return c.select("doc_id", "claim_pos", "claim_text", "claim_type", "implied_outcome", "quantifier",
                    "has_numeric_quantifier")


@query("response_fallback", f"""WITH {_RESP_CTE}, {SECTIONS_CTE},
model AS (
  SELECT doc_id, 'model' AS path, claim_pos::INTEGER AS claim_pos, {_get('text', '')} AS claim_text,
         {_get('claim_type', 'unknown')} AS claim_type, 0.9::DOUBLE AS confidence,
         CASE WHEN list_contains(json_keys(el), 'has_numeric_quantifier')
              THEN TRY_CAST(el->>'has_numeric_quantifier' AS BOOLEAN) ELSE false END AS has_numeric_quantifier
  FROM ok WHERE doc_id IN (SELECT doc_id FROM sections)),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec_ord, sent_ord) AS rn FROM sents
  WHERE doc_id NOT IN (SELECT doc_id FROM valid)
    AND regexp_matches(claim_text, {any_re(HTML_CLAIM_WORDS, grouped=False)}) AND length(claim_text) >= 10),
rules AS (
  SELECT doc_id, 'rules' AS path, (rn - 1)::INTEGER AS claim_pos, claim_text, 'unknown' AS claim_type,
         0.6::DOUBLE AS confidence, regexp_matches(claim_text, '[0-9]') AS has_numeric_quantifier
  FROM kept WHERE rn <= 20)
SELECT * FROM model UNION ALL SELECT * FROM rules""")
def response_fallback(spark, sf_dir):
    """X08 + X09: model claims where the response is valid (an empty array is
    final), rule claims for every other page with sections."""
    docs = I.load(spark, sf_dir, "documents")
    c = extract.text_claims(docs, I.model_responses(docs), ["doc_id"], "text")
    return c.select("doc_id", "path", "claim_pos", "claim_text", "claim_type", "confidence",
                    "has_numeric_quantifier")


@query("page_text", """SELECT conv_id,
  string_agg('[' || upper(role) || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS page_text
FROM conversations GROUP BY conv_id""")
def page_text(spark, sf_dir):
    """Sections (here: conversation turns) assembled into the model text."""
    conv = I.load(spark, sf_dir, "conversations")
    sections = conv.select("conv_id", F.col("turn").alias("sec_ord"), F.col("role").alias("section"), "text")
    return extract.page_text(sections, ["conv_id"])


_OCR_CTE = f"""w AS (
  SELECT doc_id, printf('D%09d_img00', doc_id) AS asset_id,
         generate_subscripts(string_split(text, ' '), 1) - 1 AS idx, unnest(string_split(text, ' ')) AS t
  FROM documents),
w2 AS (
  SELECT asset_id, idx, TRY_CAST(({arr(I.OCR_CONFS)})[idx % 5 + 1] AS DOUBLE) AS c, {strip('t')} AS word,
         (idx * 10)::INTEGER AS x1, (doc_id % 100)::INTEGER AS y1, (idx * 10 + length(t) * 7)::INTEGER AS x2,
         (doc_id % 100 + 12)::INTEGER AS y2
  FROM w),
kw AS (SELECT * FROM w2 WHERE c IS NOT NULL AND NOT isnan(c) AND c >= 0 AND c > 70.0 AND word <> ''),
texts AS (
  SELECT asset_id, string_agg(word, ' ' ORDER BY idx) AS raw_text,
         '[' || string_agg('[' || x1 || ', ' || y1 || ', ' || x2 || ', ' || y2 || ']', ', ' ORDER BY idx) || ']'
           AS bbox
  FROM kw GROUP BY asset_id)"""


@query("ocr_words", f"WITH {_OCR_CTE} SELECT asset_id, idx::INTEGER AS idx, word, x1, y1, x2, y2 FROM kw")
def ocr_words(spark, sf_dir):
    """X11 + X12: confidence filter (strictly above 70) and word boxes."""
    words = I.ocr_words(I.load(spark, sf_dir, "documents"))
    return extract.ocr_kept_words(words)


_OCR_GATE = any_re(OCR_CLAIM_WORDS, grouped=False)


@query("ocr_claims", f"""WITH {_OCR_CTE}
SELECT asset_id, 0 AS claim_pos, substr(raw_text, 1, 500) AS claim_text, bbox, 0.7::DOUBLE AS confidence,
       regexp_matches(raw_text, '[0-9]') AS has_numeric_quantifier
FROM texts WHERE regexp_matches(raw_text, {_OCR_GATE})""")
def ocr_claims(spark, sf_dir):
    """X13 + X14: words joined in reading order, one gated claim per image."""
    words = I.ocr_words(I.load(spark, sf_dir, "documents"))
    c = extract.image_claims(words)
    return c.select("asset_id", "claim_pos", "claim_text", "bbox", "confidence", "has_numeric_quantifier")


@query("ocr_precedence", f"""WITH {_OCR_CTE},
cl AS (SELECT printf('D%09d_img00', doc_id) AS asset_id, ({arr(I.OCR_CLEANUP_BODIES)})[doc_id % 4 + 1] AS body
       FROM documents),
cv AS (SELECT asset_id, body FROM cl WHERE body IS NOT NULL AND json_valid(body)
       AND json_type(body::JSON) = 'ARRAY' AND asset_id IN (SELECT asset_id FROM texts)),
ce AS (SELECT asset_id, generate_subscripts(json_extract(body, '$[*]'), 1) - 1 AS claim_pos,
              unnest(json_extract(body, '$[*]')) AS el FROM cv),
cbad AS (SELECT DISTINCT asset_id FROM ce WHERE json_type(el) <> 'OBJECT'),
model AS (
  SELECT asset_id, 'model' AS path, claim_pos::INTEGER AS claim_pos, {_get('text', '')} AS claim_text,
         {_get('claim_type', 'unknown')} AS claim_type, 0.75::DOUBLE AS confidence,
         coalesce(el->>'quantifier' IS NOT NULL AND el->>'quantifier' <> '', false) AS has_numeric_quantifier
  FROM ce WHERE asset_id NOT IN (SELECT asset_id FROM cbad)),
rules AS (
  SELECT asset_id, 'rules' AS path, 0 AS claim_pos, substr(raw_text, 1, 500) AS claim_text,
         'unknown' AS claim_type, 0.7::DOUBLE AS confidence, regexp_matches(raw_text, '[0-9]') AS has_numeric_quantifier
  FROM texts WHERE regexp_matches(raw_text, {_OCR_GATE}) AND asset_id NOT IN (SELECT asset_id FROM model))
SELECT * FROM model UNION ALL SELECT * FROM rules""")
def ocr_precedence(spark, sf_dir):
    """The cleanup answer wins only when enabled and non-empty; an empty
    array, bad JSON or no answer falls back to the OCR rules."""
    docs = I.load(spark, sf_dir, "documents")
    policy = replace(ExtractionPolicy(), use_model_for_ocr_cleanup=True)
    c = extract.image_claims(I.ocr_words(docs), I.ocr_cleanup(docs), policy)
    return c.select("asset_id", "path", "claim_pos", "claim_text", "claim_type", "confidence",
                    "has_numeric_quantifier")


@query("extraction_records", f"""WITH {FX_CTE}
SELECT product_key AS asin, CASE WHEN origin = 'html' THEN product_key || '_html' ELSE product_key || '_img00' END
         AS asset_id, origin AS source, min(claim_ord) AS rec_ord, 'gemini-2.0-flash-exp' AS extraction_model,
       'v2025-11-12' AS extraction_version, 0.0::DOUBLE AS extraction_temperature, count(*)::INTEGER AS n_claims,
       sha256(string_agg(claim_text, chr(10) ORDER BY claim_ord)) AS claims_digest,
       arg_min(page_hash, claim_ord) AS page_sha256
FROM fx GROUP BY product_key, origin""")
def extraction_records(spark, sf_dir):
    """Nested records per (product, asset) with extraction metadata."""
    from .queries import _raw
    r = _raw(spark, sf_dir)
    return r.select("asin", "asset_id", "source", "rec_ord", F.col("extraction.model").alias("extraction_model"),
                    F.col("extraction.version").alias("extraction_version"),
                    F.col("extraction.temperature").alias("extraction_temperature"),
                    F.size("claims").alias("n_claims"),
                    F.sha2(F.array_join(F.transform("claims", lambda c: c["text"]), "\n"), 256)
                     .alias("claims_digest"), "page_sha256")


@query("extraction_totals", f"""WITH {FX_CTE},
rec AS (SELECT product_key, origin, count(*) AS n FROM fx GROUP BY 1, 2)
SELECT (SELECT sum(n) FROM rec)::BIGINT AS total_claims, (SELECT count(*) FROM rec)::BIGINT AS n_records,
       (SELECT count(DISTINCT product_key) FROM fx)::BIGINT AS n_pages""")
def extraction_totals(spark, sf_dir):
    """Claims summed over records; records and pages counted."""
    from .queries import _fx
    fx = _fx(spark, sf_dir)
    return extract.extraction_totals(I.raw_records(fx), fx.select("product_key").distinct())


@query("page_claim_records")
def page_claim_records(spark, sf_dir):
    """X18 + X16 on captured pages: page index (successful captures) joined
    with the stored bodies (inner), sections, rule claims (dense fixture
    lexicon: the original words hardly occur in the pages), one record per page."""
    p = I.load(spark, sf_dir, "pages")
    idx = pages.page_index(I.captures(p))
    bodies = idx.join(p.select(F.col("page_id").alias("page_ord"), "html"), "page_ord")
    secs = html.page_sections(bodies, ["page_ord", "asin", "page_sha256"], rules=I.PAGE_SECTION_RULES)
    claims = extract.html_claims(secs, None, ["page_ord", "asin", "page_sha256"], words=I.DENSE_LEXICON)
    recs = extract.group_records(claims.withColumn("asset_id", F.concat("asin", F.lit("_html"))),
                                 ["page_ord", "asin", "asset_id", "source", "page_sha256"])
    return recs.select("page_ord", "asin", "asset_id", "source", F.size("claims").alias("n_claims"),
                       "page_sha256")
