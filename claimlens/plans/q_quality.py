"""Quality, weights, report, export and extension queries with oracle SQL
(Q01-Q08, D09, D13, W01-W06, R01-R03, E01-E03, D02-D03, D12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import BUNDLE_NAME, PHI_HINTS, K_HINTS, INGREDIENT_ALIASES, FDA_WARNINGS, REPORT_GATES, T_MIN_L_SCORE, ExtractionPolicy, HintRules
from ..operators import dictionary, export, extract, normalize, quality, report, weights
from ..operators.quality import RULE_ORDER
from ..schemas import ASSETS_SCHEMA, CLAIMS_SCHEMA, CRITICAL_CLAIM_FIELDS, PRODUCT_SCHEMA
from . import inputs as I
from .oracle import FXC_CTE, gate_expr, ids_json, lit, score_expr, tokens_expr
from .registry import query

CREATED_AT = "2025-11-12T00:00:00Z"


# ------------------------------------------------------------------ tables
def _raw(spark, sf_dir):
    docs = I.load(spark, sf_dir, "documents")
    return docs, I.written_records(docs)


def _claims_and_products(spark, sf_dir):
    docs, raw = _raw(spark, sf_dir)
    claims, products = normalize.build_tables(raw, normalize.latest_per_key(I.url_meta(docs), "asin", "frame_ord"))
    return claims, quality.row_numbers(products, "first_rec_ord").drop("first_rec_ord")


def seed_defects(c):
    """Seeded defects by claim_seq % 50: 0 null page hash, 1 temperature 0.7,
    2 enum outside the list, 3 text too short, 4 bad key."""
    k = F.col("claim_seq") % 50
    return (c.withColumn("page_sha256", F.when(k == 0, F.lit(None).cast("string")).otherwise(F.col("page_sha256")))
             .withColumn("extraction_temperature", F.when(k == 1, F.lit(0.7)).otherwise(F.col("extraction_temperature")))
             .withColumn("claim_type", F.when(k == 2, F.lit("unknown")).otherwise(F.col("claim_type")))
             .withColumn("claim_text_verbatim", F.when(k == 3, F.lit("too short"))
                         .otherwise(F.col("claim_text_verbatim")))
             .withColumn("asin", F.when(k == 4, F.lower("asin")).otherwise(F.col("asin")))
             .withColumn("row_ord", F.col("claim_seq") + 1)
             .drop("rec_ord", "claim_pos", "claim_seq"))


def claims_with_defects(spark, sf_dir):
    """Claims table (from the derived claims) with seeded defects."""
    return seed_defects(normalize.build_claims(_raw(spark, sf_dir)[1]))


def products_table(spark, sf_dir):
    claims, products = _claims_and_products(spark, sf_dir)
    return products, claims


# DuckDB file views of the same tables.
_CLAIMS_VIEW = f"""{FXC_CTE},
cl AS (
  SELECT claim_seq + 1 AS row_ord,
         CASE WHEN claim_seq % 50 = 4 THEN lower(product_key) ELSE product_key END AS asin,
         printf('%s_c%04d', product_key, claim_seq) AS claim_id,
         CASE WHEN claim_seq % 50 = 3 THEN 'too short' ELSE claim_text END AS claim_text_verbatim,
         CASE WHEN claim_seq % 50 = 2 THEN 'unknown' ELSE claim_type END AS claim_type,
         '' AS implied_outcome, '' AS quantifier, false AS has_citation, origin AS source,
         CASE WHEN origin = 'image' THEN '[[0, 0, 10, 10]]' END AS ocr_bbox,
         'gemini-2.0-flash-exp' AS extraction_model, 'v2025-11-12' AS extraction_version,
         CASE WHEN claim_seq % 50 = 1 THEN 0.7 ELSE 0.0 END::DOUBLE AS extraction_temperature,
         sha256(claim_text) AS claim_sha256, CASE WHEN claim_seq % 50 = 0 THEN NULL ELSE rec_hash END AS page_sha256,
         'wellness' AS claim_scope, regexp_matches(claim_text, '[0-9]') AS has_numeric_quantifier,
         quant_value, quant_unit, comparator,
         {ids_json('claim_text', PHI_HINTS)} AS phi_hint_ids,
         {ids_json("claim_text || ' '", K_HINTS)} AS k_hint_ids,
         '[' || {tokens_expr('claim_text', sep=', ', quote=True)} || ']' AS l_tokens,
         {score_expr('claim_text')}::INTEGER AS l_token_score, '[]' AS ingredient_hits,
         false AS medical_scope_flag, '' AS evidence_anchor_id, confidence AS extract_confidence,
         '' AS claim_group_id, {gate_expr('claim_text')} AS gate_hint, confidence < 0.8 AS review_needed
  FROM fxc)"""

_PRODUCTS_VIEW = f"""{FXC_CTE},
meta AS (
  SELECT printf('K%09d', doc_id // 5) AS asin,
         arg_max(CASE WHEN (doc_id // 5) % 4 = 0 THEN 'T' ELSE 'R' END, doc_id) AS cohort,
         arg_max(CASE WHEN (doc_id // 5) % 4 = 0 THEN 'keyword' ELSE 'random' END, doc_id) AS method,
         arg_max(upper(substr(lang, 1, 1)) || lower(substr(lang, 2)), doc_id) AS category_hint
  FROM documents WHERE lang <> 'de' GROUP BY 1),
prod AS (
  SELECT product_key AS asin, min(rec_ord) AS first_rec_ord, arg_min(rec_hash, rec_ord) AS product_sha256,
         bool_or({ids_json('claim_text', PHI_HINTS)} <> '[]') AS phi_any_candidate,
         bool_or({ids_json("claim_text || ' '", K_HINTS)} <> '[]') AS k_any_candidate,
         max({score_expr('claim_text')})::INTEGER AS l_max_token_score
  FROM fxc GROUP BY 1),
pv AS (
  SELECT row_number() OVER (ORDER BY p.first_rec_ord) AS row_ord, p.asin, 'amazon' AS platform,
         coalesce(m.category_hint, '') AS category_path, 'supplement' AS intervention_type,
         'Product ' || p.asin AS product_title, '' AS brand, NULL::DOUBLE AS price, 'USD' AS currency,
         'https://www.amazon.com/dp/' || p.asin AS product_url,
         'https://web.archive.org/web/20251112000000/...' AS wayback_url, '2025-11-12T00:00:00Z' AS captured_at,
         coalesce(m.cohort, 'R') AS sampling_cohort, coalesce(m.method, 'random') AS selection_method,
         CASE WHEN m.cohort = 'R' THEN 1.0::DOUBLE END AS sampling_weight,
         'v2025-11-12' AS sampling_frame_version, p.product_sha256, '' AS ingredients_raw,
         '[]' AS ingredients_norm, '[]' AS risk_hits, false AS fda_warning_match, p.phi_any_candidate,
         p.k_any_candidate, p.l_max_token_score
  FROM prod p LEFT JOIN meta m ON p.asin = m.asin)"""

_CLAIM_KINDS = {c: "string" for c in CLAIMS_SCHEMA["properties"]}
_CLAIM_KINDS.update({c: "boolean" for c in ("has_citation", "has_numeric_quantifier", "medical_scope_flag",
                                            "review_needed")})
_CLAIM_KINDS.update({"extraction_temperature": "double", "extract_confidence": "double", "l_token_score": "integer"})
_PRODUCT_KINDS = {c: "string" for c in PRODUCT_SCHEMA["properties"]}
_PRODUCT_KINDS.update({c: "boolean" for c in ("fda_warning_match", "phi_any_candidate", "k_any_candidate")})
_PRODUCT_KINDS.update({"price": "double", "sampling_weight": "double", "l_max_token_score": "integer"})


def _ok_sql(c: str, kind: str, rule: str, arg) -> str | None:
    if rule == "type":
        types = arg if isinstance(arg, list) else [arg]
        null_ok = "true" if "null" in types else "false"
        if kind == "string":
            nn = "string" in types
        elif kind == "boolean":
            nn = "boolean" in types
        elif kind == "integer":
            nn = "integer" in types or "number" in types
        else:
            nn = "number" in types
            if not nn and "integer" in types:
                return f"CASE WHEN {c} IS NULL THEN {null_ok} ELSE {c} = floor({c}) END"
        return f"CASE WHEN {c} IS NULL THEN {null_ok} ELSE {'true' if nn else 'false'} END"
    if rule == "enum":
        if kind == "string":
            vals = [v for v in arg if isinstance(v, str)]
        elif kind in ("integer", "double"):
            vals = [float(v) for v in arg if isinstance(v, (int, float)) and not isinstance(v, bool)]
        else:
            vals = []
        if not vals:
            return "false"
        return f"{c} IN ({', '.join(lit(v) if isinstance(v, str) else repr(v) for v in vals)})"
    if kind != "string" and rule in ("pattern", "minLength", "maxLength"):
        return None
    if kind not in ("integer", "double") and rule in ("minimum", "maximum"):
        return None
    if rule == "pattern":
        return f"{c} IS NULL OR regexp_matches({c}, {lit(arg)})"
    if rule == "minLength":
        return f"{c} IS NULL OR length({c}) >= {arg}"
    if rule == "maxLength":
        return f"{c} IS NULL OR length({c}) <= {arg}"
    if rule == "minimum":
        return f"{c} IS NULL OR {c} >= {arg}"
    return f"{c} IS NULL OR {c} <= {arg}"


def _violation_sql(view: str, table: str, schema_doc: dict, kinds: dict) -> str:
    parts, decl = [], 0
    for name in schema_doc.get("required", []):
        if name not in kinds:
            parts.append(f"SELECT row_ord, {lit(name)} AS \"column\", 'required' AS rule, {decl} AS decl FROM {view}")
            decl += 1
    for name, spec in schema_doc["properties"].items():
        if name not in kinds:
            continue
        for rule in RULE_ORDER:
            if rule not in spec:
                continue
            ok = _ok_sql(name, kinds[name], rule, spec[rule])
            if ok is not None:
                parts.append(f"SELECT row_ord, {lit(name)} AS \"column\", {lit(rule)} AS rule, {decl} AS decl "
                             f"FROM {view} WHERE NOT coalesce({ok}, false)")
            decl += 1
    body = "\n  UNION ALL ".join(parts)
    return f"""SELECT {lit(table)} AS "table", row_ord, "column", rule,
       row_number() OVER (PARTITION BY row_ord ORDER BY decl) - 1 AS rule_pos
FROM ({body})"""


# ------------------------------------------------------------------ Q04-Q08
@query("qc_violations", f"WITH {_CLAIMS_VIEW} {_violation_sql('cl', 'claims', CLAIMS_SCHEMA, _CLAIM_KINDS)}")
def qc_violations(spark, sf_dir):
    """Q01-Q04 + Q08: every failed constraint of the claims table (seeded
    defects + claims without a type), with 1-based row numbers."""
    return quality.violations(claims_with_defects(spark, sf_dir), CLAIMS_SCHEMA, "claims")


def seed_product_defects(p):
    """Seeded defects by row_ord % 50: 0 empty title, 1 negative price, 2 cohort
    outside the list, 3 no hash, 4 negative score, 5 no URL."""
    seeds = enumerate((("product_title", ""), ("price", -1.0), ("sampling_cohort", "X"), ("product_sha256", "none"),
                       ("l_max_token_score", -1), ("product_url", None)))
    return p.withColumns({name: F.when(F.col("row_ord") % 50 == k, F.lit(value).cast(p.schema[name].dataType))
                                 .otherwise(F.col(name)) for k, (name, value) in seeds})


@query("qc_product_violations", f"""WITH {_PRODUCTS_VIEW},
pvd AS (SELECT * REPLACE (
  CASE WHEN row_ord % 50 = 0 THEN '' ELSE product_title END AS product_title,
  CASE WHEN row_ord % 50 = 1 THEN -1.0 ELSE price END AS price,
  CASE WHEN row_ord % 50 = 2 THEN 'X' ELSE sampling_cohort END AS sampling_cohort,
  CASE WHEN row_ord % 50 = 3 THEN 'none' ELSE product_sha256 END AS product_sha256,
  CASE WHEN row_ord % 50 = 4 THEN -1 ELSE l_max_token_score END AS l_max_token_score,
  CASE WHEN row_ord % 50 = 5 THEN NULL ELSE product_url END AS product_url) FROM pv)
{_violation_sql('pvd', 'products', PRODUCT_SCHEMA, _PRODUCT_KINDS)}""")
def qc_product_violations(spark, sf_dir):
    """Q04 on the products table with seeded defects."""
    p, _ = products_table(spark, sf_dir)
    return quality.violations(seed_product_defects(p), PRODUCT_SCHEMA, "products")


@query("claims_within_length", f"""WITH {FXC_CTE}
SELECT printf('%s_c%04d', product_key, claim_seq) AS claim_id, length(claim_text) AS n_chars
FROM fxc WHERE length(claim_text) <= 80""")
def claims_within_length(spark, sf_dir):
    """Claims that a policy with a maximum of 80 code points keeps."""
    kept = extract.within_length(normalize.build_claims(_raw(spark, sf_dir)[1]), ExtractionPolicy(max_claim_length=80),
                                 "claim_text_verbatim")
    return kept.select("claim_id", F.length("claim_text_verbatim").cast("long").alias("n_chars"))


@query("qc_temperature", f"""WITH {_CLAIMS_VIEW}
SELECT row_ord, extraction_temperature FROM cl WHERE extraction_temperature IS NULL OR extraction_temperature <> 0""")
def qc_temperature(spark, sf_dir):
    """Q05: temperature must be exactly 0 on every row."""
    return quality.temperature_check(claims_with_defects(spark, sf_dir))


@query("qc_required", f"""WITH {_CLAIMS_VIEW}
SELECT row_ord, 'page_sha256' AS field FROM cl WHERE page_sha256 IS NULL OR page_sha256 = ''
UNION ALL SELECT row_ord, 'claim_sha256' AS field FROM cl WHERE claim_sha256 IS NULL OR claim_sha256 = ''""")
def qc_required(spark, sf_dir):
    """Q06: one error per (row, empty critical field)."""
    return quality.required_fields(claims_with_defects(spark, sf_dir), CRITICAL_CLAIM_FIELDS)


def _summary_sql() -> str:
    claims_v = _violation_sql("cl", "claims", CLAIMS_SCHEMA, _CLAIM_KINDS)
    prod_v = _violation_sql("pv", "products", PRODUCT_SCHEMA, _PRODUCT_KINDS)
    # both views share the fx/fxr/fxc CTEs: take the product CTEs after fxc
    prod_ctes = _PRODUCTS_VIEW[len(FXC_CTE) + 2:]
    return f"""WITH {_CLAIMS_VIEW}, {prod_ctes},
errs AS (
  SELECT 0 AS check_ord, row_ord FROM ({prod_v}) WHERE rule_pos = 0
  UNION ALL SELECT 1, row_ord FROM ({claims_v}) WHERE rule_pos = 0
  UNION ALL SELECT 2, row_ord FROM cl WHERE extraction_temperature IS NULL OR extraction_temperature <> 0
  UNION ALL SELECT 3, row_ord FROM cl WHERE page_sha256 IS NULL OR page_sha256 = ''
  UNION ALL SELECT 3, row_ord FROM cl WHERE claim_sha256 IS NULL OR claim_sha256 = ''),
names AS (SELECT * FROM (VALUES (0, 'product_schema'), (1, 'claims_schema'), (2, 'temperature'),
                                (3, 'critical_fields')) t(check_ord, "check")),
agg AS (SELECT check_ord, count(*) AS n FROM errs GROUP BY 1),
firsts AS (
  SELECT check_ord, string_agg(row_ord::VARCHAR, ',' ORDER BY row_ord) AS first_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY check_ord ORDER BY row_ord) AS rn FROM errs) WHERE rn <= 5
  GROUP BY 1)
SELECT n.check_ord::INTEGER AS check_ord, n."check", coalesce(a.n, 0) = 0 AS passed,
       coalesce(a.n, 0)::BIGINT AS n_errors, coalesce(f.first_rows, '') AS first_rows
FROM names n LEFT JOIN agg a ON n.check_ord = a.check_ord LEFT JOIN firsts f ON n.check_ord = f.check_ord"""


@query("qc_summary", _summary_sql())
def qc_summary(spark, sf_dir):
    """Q07: the four checks with pass/fail, error count and the first five
    failing rows (one error per row for the schema checks)."""
    clean, products = _claims_and_products(spark, sf_dir)
    claims = seed_defects(clean)
    # claims side: schema, temperature and both critical fields from one pass
    view, failed = quality.failed_rules(claims, CLAIMS_SCHEMA)
    t = F.col("extraction_temperature")
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    claim_errs = quality.check_errors(view, [(1, F.size(failed) > 0), (2, t.isNull() | (t != 0)),
                                             (3, blank(CRITICAL_CLAIM_FIELDS[0])), (3, blank(CRITICAL_CLAIM_FIELDS[1]))])
    pview, pfailed = quality.failed_rules(products, PRODUCT_SCHEMA)
    product_errs = quality.check_errors(pview, [(0, F.size(pfailed) > 0)])
    checks = [("product_schema", None), ("claims_schema", None), ("temperature", None), ("critical_fields", None)]
    return quality.summary(spark, checks, claim_errs.unionByName(product_errs))


# The same cells as text: "" is null, and only names ending in _score are numbers.
_TEXT_CELLS = ", ".join(f"nullif({c}::VARCHAR, '') AS {c}" for c, kind in _CLAIM_KINDS.items() if kind in ("string", "double"))
_SUFFIX_KINDS = {c: "string" if kind == "double" else kind for c, kind in _CLAIM_KINDS.items()}


@query("qc_suffix_coercion", f"""WITH {_CLAIMS_VIEW},
clt AS (SELECT * REPLACE ({_TEXT_CELLS}) FROM cl)
SELECT "table", row_ord, "column", rule FROM ({_violation_sql('clt', 'claims', CLAIMS_SCHEMA, _SUFFIX_KINDS)}) WHERE rule_pos = 0""")
def qc_suffix_coercion(spark, sf_dir):
    """Q02/Q03 as the original reader does it (text cells, suffix-based
    numbers): the temperature/confidence columns fail on every row."""
    v = quality.violations(claims_with_defects(spark, sf_dir), CLAIMS_SCHEMA, "claims", coercion="suffix")
    return quality.row_errors(v)


@query("qc_assets")
def qc_assets(spark, sf_dir):
    """Constraint check of the asset table extracted from the pages."""
    from .q_pages import page_assets
    a = page_assets(spark, sf_dir)
    # seeded defects: the 4th asset of a page gets a negative width, the 6th
    # a lower-case key (fixture rows, so the check is not vacuous)
    a = a.withColumn("width", F.when(F.col("asset_pos") == 3, F.lit(-1)).cast("int")) \
         .withColumn("asin", F.when(F.col("asset_pos") == 5, F.lower("asin")).otherwise(F.col("asin")))
    order = F.substring("asin", 2, 9).cast("long") * 16 + F.col("asset_pos")   # (page, asset position)
    a = quality.row_numbers(a.withColumn("_o", order), "_o").drop("_o", "asset_pos")
    return quality.violations(a, ASSETS_SCHEMA, "assets")


@query("min_score_check", f"""WITH {_PRODUCTS_VIEW}
SELECT asin, l_max_token_score, coalesce(l_max_token_score, 0) < {T_MIN_L_SCORE} AS below_min
FROM pv WHERE sampling_cohort = 'T'""")
def min_score_check(spark, sf_dir):
    """D13 (extension): targeted products below the stress threshold."""
    p, _ = products_table(spark, sf_dir)
    return quality.min_score_check(p, T_MIN_L_SCORE)


# ------------------------------------------------------------------ W01-W06
_SEG_VALUES = ", ".join(f"({lit(n)}, {a}::DOUBLE)" for n, a in I.SEGMENT_ALLOCATIONS)
_W_CTE = f"""fr AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 4 = 0 THEN 'T' ELSE 'R' END AS cohort,
                  c_mktsegment AS stratum FROM customer),
plan AS (SELECT * FROM (VALUES {_SEG_VALUES}) t(stratum, allocation)),
cnt AS (SELECT stratum, count(*) AS n FROM fr WHERE cohort = 'R' GROUP BY 1),
w AS (SELECT c.stratum, c.n, sum(c.n) OVER () AS total, p.allocation,
             coalesce(p.allocation, 1.0::DOUBLE / {len(I.SEGMENT_ALLOCATIONS)}) AS target
      FROM cnt c LEFT JOIN plan p ON c.stratum = p.stratum),
wt AS (SELECT *, round(target / (n / total), 4) AS weight FROM w)"""


def _weights(spark, sf_dir):
    fr = I.customer_frame(I.load(spark, sf_dir, "customer"))
    plan = spark.createDataFrame(list(I.SEGMENT_ALLOCATIONS), "stratum string, allocation double")
    return fr, weights.stratum_weights(fr, plan, n_plan_strata=len(I.SEGMENT_ALLOCATIONS))


@query("sampling_weights", f"""WITH {_W_CTE}
SELECT fr.key, fr.cohort, fr.stratum,
       coalesce(CASE WHEN fr.cohort = 'R' THEN wt.weight END, CASE WHEN fr.cohort = 'R' THEN 1.0 END)
         AS sampling_weight
FROM fr LEFT JOIN wt ON fr.stratum = wt.stratum""")
def sampling_weights(spark, sf_dir):
    """W01-W04 + W06: weights per R row written back to every row by key."""
    fr, w = _weights(spark, sf_dir)
    rw = weights.row_weights(fr, w)
    table = fr.withColumn("sampling_weight", F.when(F.col("cohort") == "R", F.lit(1.0)))
    return weights.apply_weights(table, rw).select("key", "cohort", "stratum", "sampling_weight")


@query("stratum_report", f"""WITH {_W_CTE}
SELECT stratum, n AS n_samples, round(n / total * 100, 1) AS actual_pct,
       round(coalesce(allocation, 0.0) * 100, 1) AS target_pct, round(weight, 3) AS avg_weight FROM wt""")
def stratum_report(spark, sf_dir):
    """Per-stratum counts, shares and mean weight."""
    _, w = _weights(spark, sf_dir)
    return weights.stratum_report(w)


# ------------------------------------------------------------------ R01-R03
def _report_sql(final: str) -> str:
    gates = [(lab, i, {"phi": "phi", "k": "k", "l": "l"}[key]) for i, (lab, key) in enumerate(REPORT_GATES)]
    from .oracle import ids_expr
    cols = {"phi": ids_expr("claim_text", PHI_HINTS), "k": ids_expr("claim_text || ' '", K_HINTS),
            "l": tokens_expr("claim_text")}
    parts = " UNION ALL ".join(
        f"SELECT claim_seq AS row_ord, {lit(lab)} AS gate, {i} AS gate_rank, {cols[k]} AS ids FROM fxc"
        for lab, i, k in gates)
    return f"""WITH {FXC_CTE},
g AS ({parts}),
e AS (SELECT row_ord, gate, gate_rank, generate_subscripts(string_split(ids, '|'), 1) - 1 AS pos,
             unnest(string_split(ids, '|')) AS pattern FROM g WHERE ids <> ''),
agg AS (SELECT gate, gate_rank, pattern, count(*) AS count, min(row_ord * 1000 + pos) AS first FROM e
        GROUP BY 1, 2, 3)
{final}"""


@query("pattern_report", _report_sql("""SELECT gate, pattern, count,
       row_number() OVER (ORDER BY gate_rank, count DESC, first) - 1 AS report_pos FROM agg"""))
def pattern_report(spark, sf_dir):
    """R01 + R02: hint ids / tokens counted per gate, ordered by gate, count
    (descending) and first appearance."""
    from .queries import _claims
    return report.pattern_counts(_claims(spark, sf_dir), row_col="claim_seq")


@query("pattern_distinct", _report_sql(f"""SELECT l.gate, l.gate_rank, coalesce(n, 0)::BIGINT AS n_patterns
FROM (VALUES {', '.join(f"({lit(lab)}, {i})" for i, (lab, _) in enumerate(REPORT_GATES))}) l(gate, gate_rank)
LEFT JOIN (SELECT gate, count(DISTINCT pattern) AS n FROM agg GROUP BY 1) c ON l.gate = c.gate"""))
def pattern_distinct(spark, sf_dir):
    """Distinct patterns per gate."""
    from .queries import _claims
    return report.distinct_patterns(report.pattern_counts(_claims(spark, sf_dir), row_col="claim_seq"))


# ------------------------------------------------------------------ E01-E03
_FP_CLAIM_COLS = ("claim_id", "asin", "claim_text_verbatim", "claim_sha256", "page_sha256", "gate_hint",
                  "l_token_score", "extract_confidence")
_FP_PRODUCT_COLS = ("asin", "product_sha256", "sampling_cohort", "selection_method", "l_max_token_score")
_FP_ASSET_COLS = ("asin", "asset_id", "asset_type", "url", "sha256")


def _fp_sql2(view: str, cols, name: str) -> str:
    row = " || ".join(f"coalesce('V' || length({c}::VARCHAR) || ':' || {c}::VARCHAR, 'N')" for c in cols)
    lanes = ", ".join(f"coalesce(sum(('0x' || substr(h, {1 + 15 * i}, 15))::UBIGINT::HUGEINT), 0)::VARCHAR AS l{i}"
                      for i in range(4))
    return f"""SELECT {lit(name)} AS table_name, n_rows,
       sha256(n_rows::VARCHAR || ':' || l0 || ':' || l1 || ':' || l2 || ':' || l3) AS fingerprint
FROM (SELECT count(*)::BIGINT AS n_rows, {lanes} FROM (SELECT sha256({row}) AS h FROM {view}))"""


_ASSETS_VIEW = """av AS (
  SELECT DISTINCT product_key AS asin, product_key || '_img00' AS asset_id, 'image' AS asset_type,
         'https://images-amazon.com/images/I/' || product_key || '_img00.jpg' AS url,
         sha256('https://images-amazon.com/images/I/' || product_key || '_img00.jpg') AS sha256
  FROM fxc WHERE origin = 'image')"""


def _assets_table(claims):
    a = claims.where(F.col("source") == "image").select("asin").distinct()
    url = F.concat(F.lit("https://images-amazon.com/images/I/"), F.col("asin"), F.lit("_img00.jpg"))
    return a.select("asin", F.concat("asin", F.lit("_img00")).alias("asset_id"), F.lit("image").alias("asset_type"),
                    url.alias("url"), F.sha2(url, 256).alias("sha256"))


@query("table_fingerprint", f"""WITH {_CLAIMS_VIEW}, {_PRODUCTS_VIEW[len(FXC_CTE) + 2:]}
{_fp_sql2('cl', _FP_CLAIM_COLS, 'claims')}
UNION ALL {_fp_sql2('pv', _FP_PRODUCT_COLS, 'products')}""")
def table_fingerprint(spark, sf_dir):
    """Order- and layout-independent fingerprints of the claims (with
    seeded defects) and products tables."""
    clean, products = _claims_and_products(spark, sf_dir)
    claims = seed_defects(clean).select(*_FP_CLAIM_COLS)
    return export.table_fingerprint(claims, name="claims").unionByName(
        export.table_fingerprint(products.select(*_FP_PRODUCT_COLS), name="products"))


@query("bundle_manifest", f"""WITH {_CLAIMS_VIEW}, {_PRODUCTS_VIEW[len(FXC_CTE) + 2:]}, {_ASSETS_VIEW},
fps AS ({_fp_sql2('av', _FP_ASSET_COLS, 'assets')}
  UNION ALL {_fp_sql2('cl', _FP_CLAIM_COLS, 'claims')}
  UNION ALL {_fp_sql2('pv', _FP_PRODUCT_COLS, 'products')})
SELECT {lit(BUNDLE_NAME)} AS bundle_name, 'v1' AS version, {lit(CREATED_AT)} AS created_at,
       sha256(string_agg(fingerprint, ':' ORDER BY table_name)) AS bundle_hash,
       max(CASE WHEN table_name = 'assets' THEN n_rows END) AS rows_assets,
       max(CASE WHEN table_name = 'claims' THEN n_rows END) AS rows_claims,
       max(CASE WHEN table_name = 'products' THEN n_rows END) AS rows_products, 'v1.0' AS pipeline_version
FROM fps""")
def bundle_manifest(spark, sf_dir):
    """E01 + E03: one-row manifest (row counts of all three tables — assets
    really counted — and the bundle fingerprint)."""
    clean_claims, products = _claims_and_products(spark, sf_dir)
    claims = seed_defects(clean_claims)
    tables = {"assets": _assets_table(clean_claims).select(*_FP_ASSET_COLS), "claims": claims.select(*_FP_CLAIM_COLS),
              "products": products.select(*_FP_PRODUCT_COLS)}
    return export.bundle_manifest(tables, CREATED_AT)


# ------------------------------------------------------------------ D02/D03/D12
def _ingredients_sql(text: str) -> str:
    parts = ", ".join(
        f"CASE WHEN regexp_matches({text}, {lit('(?i)' + chr(92) + 'b(?:' + '|'.join([c, *a]) + ')' + chr(92) + 'b')})"
        f" THEN {lit(c)} END" for c, a in sorted(INGREDIENT_ALIASES))
    return f"concat_ws('|', {parts})"


def _with_ingredients(spark, sf_dir):
    from .queries import _fx
    aliases, warnings = dictionary.rule_lists(spark, HintRules())
    return normalize.claim_ingredients(_fx(spark, sf_dir), aliases, warnings, "claim_ord", "claim_text")


@query("ingredient_norm", f"""WITH {FXC_CTE}
SELECT claim_ord, {_ingredients_sql('claim_text')} AS ingredients_norm FROM fx""")
def ingredient_norm(spark, sf_dir):
    """D02 (extension): alias table -> canonical ingredient names per claim."""
    return _with_ingredients(spark, sf_dir).select("claim_ord", F.array_join("ingredients_norm", "|").alias("ingredients_norm"))


@query("warning_match", f"""WITH {FXC_CTE}
SELECT claim_ord, coalesce(list_has_any(string_split({_ingredients_sql('claim_text')}, '|'),
                                        [{', '.join(lit(w) for w in FDA_WARNINGS)}]), false) AS fda_warning_match
FROM fx""")
def warning_match_q(spark, sf_dir):
    """D03 (extension): normalised ingredients on the warning list."""
    return _with_ingredients(spark, sf_dir).select("claim_ord", "fda_warning_match")


@query("claim_provenance", f"""WITH {_CLAIMS_VIEW}, {_PRODUCTS_VIEW[len(FXC_CTE) + 2:]}
SELECT c.claim_id, c.asin, p.wayback_url, c.page_sha256, p.product_sha256,
       coalesce(c.page_sha256 = p.product_sha256, false) AS hash_matches
FROM cl c LEFT JOIN pv p ON c.asin = p.asin""")
def claim_provenance(spark, sf_dir):
    """D12 (extension): claim -> product archive URL, with the hash check."""
    clean, products = _claims_and_products(spark, sf_dir)
    return normalize.claim_provenance(seed_defects(clean), products)


# ------------------------------------------------------------------ D14 (batch form)
_EVENT_EPOCH_US = I.CAPTURE_EPOCH_US


@query("claim_window_rollup", f"""WITH {FXC_CTE},
ev AS (SELECT make_timestamp({_EVENT_EPOCH_US} + claim_ord * 60000000) AS event_time,
              {gate_expr('claim_text')} AS gate_hint, {score_expr('claim_text')}::INTEGER AS l_token_score FROM fx)
SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start,
       time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end, gate_hint,
       count(*) AS n_claims, max(l_token_score) AS max_l_score
FROM ev GROUP BY 1, 2, 3""")
def claim_window_rollup(spark, sf_dir):
    """D14 (extension), batch form of the streaming rollup: claims per hour
    of event time (one claim per minute of ``claim_ord``) and gate hint."""
    from ..streaming.claims_stream import gate_rollup
    from ..functions.hints import with_hints as _wh
    from .queries import _fx
    fx = _fx(spark, sf_dir).withColumn(
        "event_time", F.timestamp_micros(F.lit(_EVENT_EPOCH_US) + F.col("claim_ord") * 60000000))
    return gate_rollup(_wh(fx, "claim_text"))
