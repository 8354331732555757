"""Table constraint declarations (S05/Q04) and Spark schemas of file sources.

The constraint documents have the JSON-Schema layout of the original files
(``required`` + ``properties`` with type / enum / pattern / length / range);
``config.load_table_schema`` reads such a file, the dicts below are the
defaults.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — table constraints of the original schema files.
# ---------------------------------------------------------------------------
CLAIMS_SCHEMA = {
    "required": ["asin", "claim_id", "claim_text_verbatim", "claim_type", "has_citation", "source",
                 "extraction_model", "extraction_version", "extraction_temperature", "claim_sha256", "page_sha256",
                 "claim_scope", "has_numeric_quantifier", "medical_scope_flag", "extract_confidence", "gate_hint",
                 "review_needed"],
    "properties": {
        "asin": {"type": "string", "pattern": "^[A-Z0-9]{10}$"},
        "claim_id": {"type": "string", "pattern": r"^[A-Z0-9]{10}_c\d+$"},
        "claim_text_verbatim": {"type": "string", "minLength": 10, "maxLength": 1000},
        "claim_type": {"type": "string", "enum": ["efficacy", "safety", "mechanism", "medical"]},
        "implied_outcome": {"type": ["string", "null"]},
        "quantifier": {"type": ["string", "null"]},
        "has_citation": {"type": "boolean"},
        "source": {"type": "string", "enum": ["html", "image"]},
        "ocr_bbox": {"type": ["string", "null"]},
        "extraction_model": {"type": "string"},
        "extraction_version": {"type": "string"},
        "extraction_temperature": {"type": "number", "enum": [0, 0.0]},
        "claim_sha256": {"type": "string", "pattern": "^[a-f0-9]{64}$"},
        "page_sha256": {"type": "string", "pattern": "^[a-f0-9]{64}$"},
        "claim_scope": {"type": "string", "enum": ["medical", "cosmetic", "wellness", "device_mechanism"]},
        "has_numeric_quantifier": {"type": "boolean"},
        "quant_value": {"type": ["string", "null"]},
        "quant_unit": {"type": ["string", "null"]},
        "comparator": {"type": ["string", "null"]},
        "phi_hint_ids": {"type": ["string", "null"]},
        "k_hint_ids": {"type": ["string", "null"]},
        "l_tokens": {"type": ["string", "null"]},
        "l_token_score": {"type": ["integer", "null"], "minimum": 0},
        "ingredient_hits": {"type": ["string", "null"]},
        "medical_scope_flag": {"type": "boolean"},
        "evidence_anchor_id": {"type": ["string", "null"]},
        "extract_confidence": {"type": "number", "minimum": 0, "maximum": 1},
        "claim_group_id": {"type": ["string", "null"]},
        "gate_hint": {"type": "string", "enum": ["none", "phi_candidate", "k_candidate", "l_soft", "l_hard"]},
        "review_needed": {"type": "boolean"},
    },
}

PRODUCT_SCHEMA = {
    "required": ["asin", "platform", "intervention_type", "product_title", "product_url", "wayback_url",
                 "captured_at", "sampling_cohort", "selection_method", "sampling_frame_version", "product_sha256"],
    "properties": {
        "asin": {"type": "string", "pattern": "^[A-Z0-9]{10}$"},
        "platform": {"type": "string", "enum": ["amazon"]},
        "category_path": {"type": ["string", "null"]},
        "intervention_type": {"type": "string", "enum": ["supplement", "device_noninvasive", "food", "behavioral",
                                                         "cosmetic", "pharmaceutical", "other"]},
        "product_title": {"type": "string", "minLength": 1},
        "brand": {"type": ["string", "null"]},
        "price": {"type": ["number", "null"], "minimum": 0},
        "currency": {"type": ["string", "null"]},
        "product_url": {"type": "string"},
        "wayback_url": {"type": "string"},
        "captured_at": {"type": "string"},
        "sampling_cohort": {"type": "string", "enum": ["R", "T"]},
        "selection_method": {"type": "string", "enum": ["random", "node_id", "keyword", "bestseller"]},
        "sampling_weight": {"type": ["number", "null"], "minimum": 0},
        "sampling_frame_version": {"type": "string", "pattern": r"^v\d{4}-\d{2}-\d{2}$"},
        "product_sha256": {"type": "string", "pattern": "^[a-f0-9]{64}$"},
        "ingredients_raw": {"type": ["string", "null"]},
        "ingredients_norm": {"type": ["string", "null"]},
        "risk_hits": {"type": ["string", "null"]},
        "fda_warning_match": {"type": ["boolean", "null"]},
        "phi_any_candidate": {"type": ["boolean", "null"]},
        "k_any_candidate": {"type": ["boolean", "null"]},
        "l_max_token_score": {"type": ["integer", "null"], "minimum": 0},
    },
}

ASSETS_SCHEMA = {
    "required": ["asin", "asset_id", "asset_type", "url", "sha256"],
    "properties": {
        "asin": {"type": "string", "pattern": "^[A-Z0-9]{10}$"},
        "asset_id": {"type": "string"},
        "asset_type": {"type": "string", "enum": ["html", "image"]},
        "url": {"type": "string"},
        "wayback_url": {"type": ["string", "null"]},
        "sha256": {"type": "string", "pattern": "^[a-f0-9]{64}$"},
        "storage_uri": {"type": ["string", "null"]},
        "width": {"type": ["integer", "null"], "minimum": 0},
        "height": {"type": ["integer", "null"], "minimum": 0},
    },
}

# Columns the critical-field check looks at (claims table).
CRITICAL_CLAIM_FIELDS = ("page_sha256", "claim_sha256")
# Suffix rule of the original numeric coercion.
INT_SUFFIXES = ("_score",)
FLOAT_SUFFIXES = ("_weight", "price")
# ---------------------------------------------------------------------------

# Spark DDL of the pipeline files (explicit schemas, no inference).
FRAME_DDL = ("frame_ord BIGINT, asin STRING, url STRING, cohort STRING, method STRING, category_hint STRING, "
             "stratum STRING")
PAGES_INDEX_DDL = ("page_ord BIGINT, asin STRING, page_sha256 STRING, wayback_url STRING, captured_at STRING, "
                   "status_code INT")
ASSETS_DDL = ("asin STRING, asset_id STRING, asset_type STRING, url STRING, wayback_url STRING, sha256 STRING, "
              "storage_uri STRING, width INT, height INT")
RAW_DDL = ("rec_ord BIGINT, asin STRING, asset_id STRING, source STRING, "
           "extraction STRUCT<model: STRING, version: STRING, temperature: DOUBLE>, "
           "claims ARRAY<STRUCT<text: STRING, source: STRING, confidence: DOUBLE, bbox: STRING, claim_type: STRING, "
           "implied_outcome: STRING, quantifier: STRING, has_numeric_quantifier: BOOLEAN, "
           "quant_value: STRING, quant_unit: STRING, comparator: STRING>>, page_sha256 STRING")
