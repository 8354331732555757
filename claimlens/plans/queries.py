"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Names follow the operator inventory (SURVEY §2).  Every query reads the given
tables (or relations Spark derives from them) in full and returns flat,
aliased columns so it can be compared with the DuckDB oracle in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import HTML_CLAIM_WORDS, ExtractionPolicy
from ..functions.hints import gate_hint, k_hint_ids, l_score, l_tokens, phi_hint_ids, with_hints
from ..functions.jsontext import json_list_text
from ..operators import extract, normalize
from . import inputs as I
from .registry import REGISTRY, query


def _fx(spark, sf_dir):
    return I.derived_claims(I.load(spark, sf_dir, "documents"))


def _raw(spark, sf_dir):
    return I.raw_records(_fx(spark, sf_dir))


def _claims(spark, sf_dir, **kw):
    return normalize.build_claims(I.written_records(I.load(spark, sf_dir, "documents")), **kw)


# --------------------------------------------------------------- extraction
def _sentence_claims(spark, sf_dir, words):
    docs = I.load(spark, sf_dir, "documents")
    c = extract.rule_claims_per_row(docs, ["doc_id"], "text", ExtractionPolicy(), words=words)
    return c.select("doc_id", "claim_pos", "claim_text", "has_numeric_quantifier")


@query("sentence_claims")
def sentence_claims(spark, sf_dir):
    """X03-X07 with the original claim words."""
    return _sentence_claims(spark, sf_dir, HTML_CLAIM_WORDS)


@query("sentence_claims_dense")
def sentence_claims_dense(spark, sf_dir):
    """X03-X07 with a dense fixture lexicon (the 20-per-page cap binds)."""
    return _sentence_claims(spark, sf_dir, I.DENSE_LEXICON)


@query("section_claims_dense")
def section_claims_dense(spark, sf_dir):
    """X03-X07 on section rows (one row per line): the window form of the
    extractor (partial WindowGroupLimit before the shuffle); same answer as
    ``sentence_claims_dense``."""
    docs = I.load(spark, sf_dir, "documents")
    c = extract.rule_claims(I.document_sections(docs), ["doc_id"], ExtractionPolicy(), words=I.DENSE_LEXICON)
    return c.select("doc_id", "claim_pos", "claim_text", "has_numeric_quantifier")


@query("doc_claim_rollup")
def doc_claim_rollup(spark, sf_dir):
    """Minimum slice: documents -> sentences -> claim filter -> cap -> hints ->
    rollup per document."""
    docs = I.load(spark, sf_dir, "documents")
    c = extract.rule_claims_per_row(docs, ["doc_id"], "text")
    c = with_hints(c, "claim_text")
    return c.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_claims"),
        F.bool_or(F.size("phi_hint_ids") > 0).alias("phi_any_candidate"),
        F.bool_or(F.size("k_hint_ids") > 0).alias("k_any_candidate"),
        F.max("l_token_score").alias("l_max_token_score"),
        F.sum(F.col("has_numeric_quantifier").cast("int")).cast("long").alias("n_numeric"))


# --------------------------------------------------------------- hints
@query("hint_phi")
def hint_phi(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return fx.select("claim_ord", F.array_join(phi_hint_ids(F.col("claim_text")), "|").alias("phi_hint_ids"))


@query("hint_k")
def hint_k(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return fx.select("claim_ord", F.array_join(k_hint_ids(F.col("claim_text")), "|").alias("k_hint_ids"))


@query("hint_l")
def hint_l(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    t = F.col("claim_text")
    return fx.select("claim_ord", F.array_join(l_tokens(t), "|").alias("l_tokens"),
                     l_score(t).alias("l_token_score"))


@query("gate_hint")
def gate_hint_q(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    t = F.col("claim_text")
    return fx.select("claim_ord", gate_hint(phi_hint_ids(t), k_hint_ids(t), l_score(t)).alias("gate_hint"))


# --------------------------------------------------------------- normalisation
@query("claims_normalized")
def claims_normalized(spark, sf_dir):
    c = _claims(spark, sf_dir)
    return c.select(
        "claim_id", "asin", "claim_text_verbatim", "claim_type", "quant_value", "quant_unit", "comparator", "source", "ocr_bbox", "extraction_model",
        "extraction_version", "extraction_temperature", "claim_sha256", "page_sha256", "has_numeric_quantifier",
        json_list_text(F.col("phi_hint_ids")).alias("phi_hint_ids"),
        json_list_text(F.col("k_hint_ids")).alias("k_hint_ids"),
        json_list_text(F.col("l_tokens")).alias("l_tokens"), "l_token_score", "extract_confidence", "gate_hint",
        "review_needed")


@query("claim_sequence")
def claim_sequence(spark, sf_dir):
    c = _claims(spark, sf_dir)
    return c.select("claim_id", "claim_seq", "rec_ord", "claim_pos")


@query("product_rollup")
def product_rollup(spark, sf_dir):
    docs = I.load(spark, sf_dir, "documents")
    raw = I.written_records(docs)
    meta = normalize.latest_per_key(I.url_meta(docs), "asin", "frame_ord")
    p = normalize.build_tables(raw, meta, with_risk_hits=True)[1]
    return p.select("asin", "category_path", "sampling_cohort", "selection_method", "sampling_weight",
                    "product_sha256", F.array_join("risk_hits", "|").alias("risk_hits"), "phi_any_candidate",
                    "k_any_candidate", "l_max_token_score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(REGISTRY)


def _load_all():
    from . import oracle, q_bundle, q_caps, q_classify, q_dictionary, q_extract, q_frame, q_groups, q_pages, q_quality, q_storage  # noqa: F401  (registration side effects)
