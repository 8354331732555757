"""Claims table and product rollup.

Input is the raw extraction relation ``(rec_ord, asin, asset_id, source,
extraction struct, claims array<struct>, page_sha256)``; ``rec_ord`` is the
record order (file order in the original, an explicit column here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import (PRODUCT_URL_PREFIX, REVIEW_CONFIDENCE_BELOW, SAMPLING_FRAME_VERSION, HintRules)
from ..functions.hints import ingredients_norm, with_hints
from ..functions.text import empty_string_array, zero_pad
from ..session import written
from .dictionary import names_per_row, warned
from .extract import OPTIONAL_FIELDS
from .sequence import ordinal

# Constants of every product row and the tables' columns (N07/§1.3).
PRODUCT_CONSTANTS = {
    "platform": "amazon",
    "intervention_type": "supplement",
    "currency": "USD",
    "wayback_url": "https://web.archive.org/web/20251112000000/...",
    "captured_at": "2025-11-12 00:00:00",
}

CLAIM_COLUMNS = (
    "asin", "claim_id", "claim_text_verbatim", "claim_type", "implied_outcome", "quantifier", "has_citation",
    "source", "ocr_bbox", "extraction_model", "extraction_version", "extraction_temperature", "claim_sha256",
    "page_sha256", "claim_scope", "has_numeric_quantifier", "quant_value", "quant_unit", "comparator",
    "phi_hint_ids", "k_hint_ids", "l_tokens", "l_token_score", "ingredient_hits", "medical_scope_flag",
    "evidence_anchor_id", "extract_confidence", "claim_group_id", "gate_hint", "review_needed")

PRODUCT_COLUMNS = (
    "asin", "platform", "category_path", "intervention_type", "product_title", "brand", "price", "currency",
    "product_url", "wayback_url", "captured_at", "sampling_cohort", "selection_method", "sampling_weight",
    "sampling_frame_version", "product_sha256", "ingredients_raw", "ingredients_norm", "risk_hits",
    "fda_warning_match", "phi_any_candidate", "k_any_candidate", "l_max_token_score")


def latest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key, the **last** row in ``order_col`` order wins
    (dict overwrite); ``first_ord`` keeps the position of the first occurrence.
    A partial aggregation, so a hot key is combined map-side."""
    cols = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("_last"),
                              F.min(order_col).alias("first_ord"))
    return agg.select(key, "first_ord", *[F.col("_last")[c].alias(c) for c in cols])


def explode_claims(raw: DataFrame) -> DataFrame:
    """N01 + N05: one row per claim with the **global** 0-based sequence number
    (records in ``rec_ord`` order, claims in array order).

    The offsets are a two-level prefix sum of ``size(claims)`` over records
    (see ``sequence.ordinal``), so no task ever sees all records."""
    with_off = ordinal(raw.withColumn("_n", F.size("claims")), "rec_ord", weight="_n", name="_offset")
    return (with_off.select("*", F.posexplode("claims").alias("claim_pos", "claim"))
                    .withColumn("claim_seq", F.col("_offset") + F.col("claim_pos"))
                    .drop("_n", "_offset"))


def build_claims(raw: DataFrame, rules: HintRules = HintRules(), review_below: float = REVIEW_CONFIDENCE_BELOW,
                 with_ingredients: bool = False) -> DataFrame:
    """The 30-column claims table (typed; arrays stay arrays until the
    CSV sink).  Extra columns ``claim_seq``, ``rec_ord``, ``claim_pos`` carry
    the order."""
    c = explode_claims(raw)
    claim = F.col("claim")
    text = claim["text"]
    given = set(raw.schema["claims"].dataType.elementType.names)

    def field(name: str, default: str):
        """The claim's value; the default where the key is absent or null."""
        return F.coalesce(claim[name], F.lit(default)) if name in given else F.lit(default)
    confidence = claim["confidence"] if "confidence" in given else F.lit(None).cast("double")
    c = c.select(
        "rec_ord", "claim_pos", "claim_seq", "asin",
        F.concat(F.col("asin"), F.lit("_c"), zero_pad(F.col("claim_seq"), 4)).alias("claim_id"),
        text.alias("claim_text_verbatim"), field("claim_type", "efficacy").alias("claim_type"),
        field("implied_outcome", "").alias("implied_outcome"), field("quantifier", "").alias("quantifier"),
        F.lit(False).alias("has_citation"), field("source", "html").alias("source"),
        (claim["bbox"] if "bbox" in given else F.lit(None).cast("string")).alias("ocr_bbox"), F.col("extraction.model").alias("extraction_model"),
        F.col("extraction.version").alias("extraction_version"),
        F.col("extraction.temperature").alias("extraction_temperature"),
        F.sha2(text, 256).alias("claim_sha256"), "page_sha256", F.lit("wellness").alias("claim_scope"),
        (F.coalesce(claim["has_numeric_quantifier"], F.lit(False)) if "has_numeric_quantifier" in given else F.lit(False)).alias("has_numeric_quantifier"),
        *[field(n, "").alias(n) for n in OPTIONAL_FIELDS],
        F.coalesce(confidence, F.lit(0.9)).alias("extract_confidence"),
        (F.coalesce(confidence, F.lit(1.0)) < F.lit(review_below)).alias("review_needed"))
    ingredients = None
    if with_ingredients:
        c = c.withColumn("ingredient_hits", ingredients_norm(F.col("claim_text_verbatim"), rules))
        ingredients = "ingredient_hits"
    else:
        c = c.withColumn("ingredient_hits", empty_string_array())
    c = with_hints(c, "claim_text_verbatim", ingredients, rules)
    return c.select("rec_ord", "claim_pos", "claim_seq", *CLAIM_COLUMNS[:-11], "phi_hint_ids", "k_hint_ids",
                    "l_tokens", "l_token_score", "ingredient_hits", F.lit(False).alias("medical_scope_flag"),
                    F.lit("").alias("evidence_anchor_id"), "extract_confidence", F.lit("").alias("claim_group_id"),
                    "gate_hint", "review_needed")


def product_rollup(claims: DataFrame) -> DataFrame:
    """N11 + D04: any phi, any K, max L score and the distinct K ids per product
    (partial aggregation; the K-id set is bounded by the rule count)."""
    k_ids = claims.select("asin", F.explode("k_hint_ids").alias("k_id"))
    flags = claims.groupBy("asin").agg(F.bool_or(F.size("phi_hint_ids") > 0).alias("phi_any_candidate"),
                                       F.bool_or(F.size("k_hint_ids") > 0).alias("k_any_candidate"),
                                       F.max("l_token_score").alias("l_max_token_score"))
    risks = k_ids.groupBy("asin").agg(F.array_sort(F.collect_set("k_id")).alias("risk_hits"))
    return flags.join(risks, "asin", "left")


def build_products(raw: DataFrame, claims: DataFrame, url_meta: DataFrame | None = None,
                   frame_version: str = SAMPLING_FRAME_VERSION, with_risk_hits: bool = False) -> DataFrame:
    """One product per key of the raw records (a record
    with an empty claim list still creates it); the first record's page hash;
    URL metadata by left join (no match -> cohort R, method random, empty
    category, **null** weight); rollup flags through a left join."""
    first = raw.groupBy("asin").agg(F.min_by("page_sha256", "rec_ord").alias("product_sha256"),
                                    F.min("rec_ord").alias("first_rec_ord"))
    roll = product_rollup(claims)
    p = first.join(roll, "asin", "left")
    if url_meta is not None:
        meta = url_meta.select("asin", F.col("cohort").alias("_cohort"), F.col("method").alias("_method"),
                               F.col("category_hint").alias("_category"))
        p = p.join(meta, "asin", "left")
    else:
        p = p.withColumn("_cohort", F.lit(None).cast("string")).withColumn("_method", F.lit(None).cast("string")) \
             .withColumn("_category", F.lit(None).cast("string"))
    risk = F.coalesce(F.col("risk_hits"), empty_string_array()) if with_risk_hits else empty_string_array()
    return p.select(
        "first_rec_ord", "asin", F.lit(PRODUCT_CONSTANTS["platform"]).alias("platform"),
        F.coalesce(F.col("_category"), F.lit("")).alias("category_path"),
        F.lit(PRODUCT_CONSTANTS["intervention_type"]).alias("intervention_type"),
        F.concat(F.lit("Product "), F.col("asin")).alias("product_title"), F.lit("").alias("brand"),
        F.lit(None).cast("double").alias("price"), F.lit(PRODUCT_CONSTANTS["currency"]).alias("currency"),
        F.concat(F.lit(PRODUCT_URL_PREFIX), F.col("asin")).alias("product_url"),
        F.lit(PRODUCT_CONSTANTS["wayback_url"]).alias("wayback_url"),
        F.lit(PRODUCT_CONSTANTS["captured_at"]).cast("timestamp").alias("captured_at"),
        F.coalesce(F.col("_cohort"), F.lit("R")).alias("sampling_cohort"),
        F.coalesce(F.col("_method"), F.lit("random")).alias("selection_method"),
        F.when(F.col("_cohort") == "R", F.lit(1.0)).alias("sampling_weight"),
        F.lit(frame_version).alias("sampling_frame_version"), "product_sha256", F.lit("").alias("ingredients_raw"),
        empty_string_array().alias("ingredients_norm"), risk.alias("risk_hits"),
        F.lit(False).alias("fda_warning_match"),
        F.coalesce(F.col("phi_any_candidate"), F.lit(False)).alias("phi_any_candidate"),
        F.coalesce(F.col("k_any_candidate"), F.lit(False)).alias("k_any_candidate"),
        F.coalesce(F.col("l_max_token_score"), F.lit(0)).alias("l_max_token_score"))


def build_tables(raw: DataFrame, url_meta: DataFrame | None = None, rules: HintRules = HintRules(), **products) -> tuple[DataFrame, DataFrame]:
    """Claims and products of the same records (a written table: all steps read
    it): ``build_claims`` and ``build_products``, for which the claims are written
    once to the shared folder instead of derived anew by every use."""
    claims = written(build_claims(raw, rules), "claims")
    return claims, build_products(raw, claims, url_meta, **products)


def claim_ingredients(claims: DataFrame, aliases: DataFrame, warnings: DataFrame, id_col: str = "claim_id",
                      text_col: str = "claim_text_verbatim") -> DataFrame:
    """D02 + D03 (extensions): normalised ingredients per claim from a list table
    (phrase, name), and whether one is on the warning list (name)."""
    found = names_per_row(claims, id_col, text_col, aliases)
    flagged = warned(found, warnings, id_col).withColumn("_warned", F.lit(True))
    return claims.join(found, id_col, "left").join(flagged, id_col, "left") \
        .withColumn("ingredients_norm", F.coalesce("names", empty_string_array())) \
        .withColumn("fda_warning_match", F.coalesce("_warned", F.lit(False))).drop("names", "_warned")


def claim_provenance(claims: DataFrame, products: DataFrame) -> DataFrame:
    """D12 (extension): claim -> product archive URL, with a hash-equality check
    of the claim's page hash against the product hash."""
    p = products.select("asin", "wayback_url", "product_sha256")
    return claims.join(p, "asin", "left").select(
        "claim_id", "asin", "wayback_url", "page_sha256", "product_sha256",
        F.coalesce(F.col("page_sha256") == F.col("product_sha256"), F.lit(False)).alias("hash_matches"))
