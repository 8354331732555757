"""Claim extraction (X02-X19) as DataFrame operators.

Inputs are tables, not services: sections of pages ``(keys..., sec_ord,
section, text)``, model responses ``(keys..., body)``, OCR word rows
``(asset_id, idx, text, conf, left, top, width, height)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import (CONFIDENCE_MODEL_HTML, CONFIDENCE_MODEL_OCR, CONFIDENCE_RULES_HTML, CONFIDENCE_RULES_OCR,
                      HTML_CLAIM_WORDS, OCR_CLAIM_WORDS, OCR_TEXT_LIMIT, ExtractionPolicy)
from ..functions.text import ascii_fold, has_digit, keyword_predicate, py_strip, sentences
from ..session import spread
from .sequence import top_rows_per_group

CLAIM_FIELDS = ("claim_text", "source", "confidence", "bbox", "claim_type", "implied_outcome", "quantifier",
                "has_numeric_quantifier")
#: Claim fields that only some extractors give.
OPTIONAL_FIELDS = ("quant_value", "quant_unit", "comparator")
RESPONSE_TYPE = "array<map<string,string>>"
CLAIM_STRUCT = ("struct<text:string,source:string,confidence:double,bbox:string,claim_type:string,"
                "implied_outcome:string,quantifier:string,has_numeric_quantifier:boolean>")


def truncate_section(text: Column, limit: int | None) -> Column:
    """Keep the first ``limit`` code points (Spark substring counts code points)."""
    return text if limit is None else F.substring(text, 1, int(limit))


def split_sentences(sections: DataFrame, keys) -> DataFrame:
    """One row per ``[.!?]+`` piece, trimmed like ``str.strip``."""
    return (sections.select(*keys, "sec_ord", F.posexplode(sentences(F.col("text"))).alias("sent_ord", "_piece"))
                    .select(*keys, "sec_ord", "sent_ord", py_strip(F.col("_piece")).alias("claim_text")))


def rule_claims(sections: DataFrame, keys, policy: ExtractionPolicy = ExtractionPolicy(),
                words=HTML_CLAIM_WORDS) -> DataFrame:
    """Sentences that contain a claim word and are long enough, at most
    ``max_rule_claims`` per page in (section, sentence) order."""
    keys = list(keys)
    s = split_sentences(sections, keys)
    s = s.where((F.length("claim_text") >= policy.min_claim_length)
                & keyword_predicate(F.col("claim_text"), words))
    s = top_rows_per_group(s, keys, [F.col("sec_ord"), F.col("sent_ord")], policy.max_rule_claims,
                           name="_rank", keep_rank=True)
    return s.select(*keys, (F.col("_rank") - 1).alias("claim_pos"), "claim_text",
                    F.lit("html").alias("source"), F.lit(CONFIDENCE_RULES_HTML).alias("confidence"),
                    F.lit(None).cast("string").alias("bbox"), F.lit("unknown").alias("claim_type"),
                    F.lit("").alias("implied_outcome"), F.lit("").alias("quantifier"),
                    has_digit(F.col("claim_text")).alias("has_numeric_quantifier"))


def within_length(claims: DataFrame, policy: ExtractionPolicy = ExtractionPolicy(), text_col: str = "claim_text") -> DataFrame:
    """D05 (optional; no extractor applies it by itself): claims of at most
    ``max_claim_length`` code points.  Claims without a text stay."""
    return claims.where(F.coalesce(F.length(text_col) <= policy.max_claim_length, F.lit(True)))


def parse_response(body: Column):
    """X08/X09 validity: exactly one JSON array whose every element is an object.

    The body is parsed as the content of an outer array, so a second value or
    trailing text makes the outer array longer or malformed.  A top-level
    object, a scalar or null element, single quotes and unquoted names are
    invalid; ``NaN`` and ``Infinity`` are accepted, as ``json.loads`` does."""
    outer = F.from_json(F.concat(F.lit("["), body, F.lit("]")), f"array<{RESPONSE_TYPE}>",
                        {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"})
    parsed = F.get(outer, F.lit(0))
    ok = (F.size(outer) == 1) & parsed.isNotNull() & ~F.exists(parsed, lambda m: m.isNull())
    return parsed, F.coalesce(ok, F.lit(False))


def _get(m: Column, key: str, default) -> Column:
    """``dict.get(key, default)``: the default only when the key is absent."""
    return F.when(F.map_contains_key(m, key), m[key]).otherwise(default)


def response_claims(responses: DataFrame, keys, source: str = "html", confidence: float = CONFIDENCE_MODEL_HTML,
                    numeric_from_quantifier: bool = False) -> DataFrame:
    """X08 (and the parse half of X15): claims of valid responses, in array order.
    Returns columns ``keys + claim_pos + CLAIM_FIELDS + n_claims``; a valid
    empty array gives a row with ``claim_pos`` null so callers can see it."""
    keys = list(keys)
    parsed, ok = parse_response(F.col("body"))
    good = responses.where(ok).select(*keys, parsed.alias("_claims"))
    exploded = good.select(*keys, F.size("_claims").alias("n_claims"),
                           F.posexplode_outer("_claims").alias("claim_pos", "_m"))
    m = F.col("_m")
    if numeric_from_quantifier:
        q = m["quantifier"]
        numeric = F.coalesce(q.isNotNull() & (q != ""), F.lit(False))
    else:
        numeric = F.when(F.map_contains_key(m, "has_numeric_quantifier"),
                         m["has_numeric_quantifier"].try_cast("boolean")).otherwise(F.lit(False))
    return exploded.select(
        *keys, "n_claims", "claim_pos",
        _get(m, "text", F.lit("")).alias("claim_text"), F.lit(source).alias("source"),
        F.lit(confidence).alias("confidence"), F.lit(None).cast("string").alias("bbox"),
        _get(m, "claim_type", F.lit("unknown")).alias("claim_type"),
        _get(m, "implied_outcome", F.lit("")).alias("implied_outcome"),
        _get(m, "quantifier", F.lit("")).alias("quantifier"),
        numeric.alias("has_numeric_quantifier"))


def html_claims(sections: DataFrame, responses: DataFrame | None, keys,
                policy: ExtractionPolicy = ExtractionPolicy(), words=HTML_CLAIM_WORDS) -> DataFrame:
    """X08 + X09: model claims for pages with a valid response (an empty array
    is a valid answer: no claims, no fallback), rule claims for every other page
    that has sections.  Pages without sections yield nothing."""
    policy.check_deterministic()
    keys = list(keys)
    pages = sections.select(*keys).distinct()
    if not policy.use_model or responses is None:
        return rule_claims(sections, keys, policy, words).withColumn("path", F.lit("rules"))
    parsed, ok = parse_response(F.col("body"))
    valid = responses.where(ok).select(*keys).distinct().join(pages, keys, "left_semi")
    model = (response_claims(responses.join(valid, keys, "left_semi"), keys)
             .where(F.col("claim_pos").isNotNull()).drop("n_claims").withColumn("path", F.lit("model")))
    fallback = sections.join(valid, keys, "left_anti")
    rules = rule_claims(fallback, keys, policy, words).withColumn("path", F.lit("rules"))
    return model.unionByName(rules)


def page_text(sections: DataFrame, keys) -> DataFrame:
    """``[SECTION]\\ntext`` blocks in section order joined by a blank line
    (the text a model receives for one page)."""
    keys = list(keys)
    blocks = F.array_sort(F.collect_list(F.struct("sec_ord", "section", "text")))
    return sections.groupBy(*keys).agg(
        F.array_join(F.transform(blocks, lambda b: F.concat(F.lit("["), F.upper(b["section"]), F.lit("]\n"),
                                                            b["text"])), "\n\n").alias("page_text"))


def py_float(s: Column) -> Column:
    """``float(s)`` or null.  Strings that cannot start a number are rejected
    before the cast (a failing cast throws inside the JVM, which is costly per
    row); the infinity spellings Python accepts are mapped explicitly."""
    t = F.lower(py_strip(s))
    return (F.when(s.rlike(r"^\s*[+-]?\.?[0-9]"), s.try_cast("double"))
             .when(t.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
             .when(t.isin("-inf", "-infinity"), F.lit(float("-inf")))
             .when(t.isin("nan", "+nan", "-nan"), F.lit(float("nan"))))


def ocr_kept_words(words: DataFrame, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """X11 + X12: numeric confidence, not negative, strictly above the
    threshold (0.7 -> 70), non-blank word; box ``[l, t, l+w, t+h]``.  ``nan``
    never passes (Spark orders NaN above every number, hence the test)."""
    conf = py_float(F.col("conf"))
    word = py_strip(F.col("text"))
    threshold = policy.ocr_confidence_threshold * 100
    keep = F.coalesce((conf > F.lit(max(threshold, 0.0))) & ~F.isnan(conf), F.lit(False)) & (word != "")
    if threshold < 0:   # then ``conf >= 0`` is the binding test
        keep = keep & (conf >= 0)
    return words.where(keep).select(
        "asset_id", "idx", word.alias("word"), F.col("left").alias("x1"), F.col("top").alias("y1"),
        (F.col("left") + F.col("width")).alias("x2"), (F.col("top") + F.col("height")).alias("y2"))


def ocr_text(kept: DataFrame) -> DataFrame:
    """Words of one image in reading order, space-joined, with the list of
    boxes rendered like Python's ``str(list)``."""
    w = F.array_sort(F.collect_list(F.struct("idx", "word", "x1", "y1", "x2", "y2")))
    box = lambda b: F.concat(F.lit("["), F.concat_ws(", ", b["x1"].cast("string"), b["y1"].cast("string"),
                                                     b["x2"].cast("string"), b["y2"].cast("string")), F.lit("]"))
    return kept.groupBy("asset_id").agg(
        F.array_join(F.transform(w, lambda b: b["word"]), " ").alias("raw_text"),
        F.concat(F.lit("["), F.array_join(F.transform(w, box), ", "), F.lit("]")).alias("bbox"))


def ocr_rule_claims(texts: DataFrame, words=OCR_CLAIM_WORDS) -> DataFrame:
    """At most one claim per image, gated by the OCR word list; the text is
    cut to 500 code points but the numeric flag looks at the full text."""
    raw = F.col("raw_text")
    return texts.where(keyword_predicate(raw, words)).select(
        "asset_id", F.lit(0).alias("claim_pos"), F.substring(raw, 1, OCR_TEXT_LIMIT).alias("claim_text"),
        F.lit("image").alias("source"), F.lit(CONFIDENCE_RULES_OCR).alias("confidence"), "bbox",
        F.lit("unknown").alias("claim_type"), F.lit("").alias("implied_outcome"), F.lit("").alias("quantifier"),
        has_digit(raw).alias("has_numeric_quantifier"))


def image_claims(words: DataFrame, cleanup: DataFrame | None = None,
                 policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """OCR claims per image.  The cleanup response wins only when
    cleanup is enabled and it parses to a **non-empty** array (the opposite of
    the HTML rule, where an empty array is final)."""
    policy.check_deterministic()
    texts = ocr_text(ocr_kept_words(words, policy))
    rules = ocr_rule_claims(texts).withColumn("path", F.lit("rules"))
    if not policy.use_model_for_ocr_cleanup or cleanup is None:
        return rules
    cand = cleanup.join(texts.select("asset_id"), "asset_id", "left_semi")
    model = (response_claims(cand, ["asset_id"], source="image", confidence=CONFIDENCE_MODEL_OCR,
                             numeric_from_quantifier=True)
             .where(F.col("n_claims") > 0).drop("n_claims").withColumn("path", F.lit("model")))
    winners = model.select("asset_id").distinct()
    return model.unionByName(rules.join(winners, "asset_id", "left_anti"))


def group_records(claims: DataFrame, keys, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """One nested record per (page, asset) holding its claims in order,
    with the extraction metadata; only groups with at least one claim exist."""
    policy.check_deterministic()
    keys = list(keys)
    item = F.struct(F.col("claim_pos"), F.struct(
        F.col("claim_text").alias("text"), "source", "confidence", "bbox", "claim_type", "implied_outcome",
        "quantifier", "has_numeric_quantifier").alias("c"))
    return claims.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items")).select(
        *keys,
        F.struct(F.lit(policy.model).alias("model"), F.lit(policy.version).alias("version"),
                 F.lit(float(policy.temperature)).alias("temperature")).alias("extraction"),
        F.transform("_items", lambda x: x["c"]).alias("claims"))


def extraction_totals(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Claims summed over records, records and pages counted — one
    aggregation over a union, so both inputs are scanned once."""
    parts = records.select(F.size("claims").cast("long").alias("c"), F.lit(1).alias("r"), F.lit(0).alias("p")) \
        .unionByName(pages.select(F.lit(0).cast("long").alias("c"), F.lit(0).alias("r"), F.lit(1).alias("p")))
    return parts.agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("total_claims"),
                     F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("n_records"),
                     F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("n_pages"))


def text_sections(text: Column) -> Column:
    """Sections of a page held as one text: its non-blank lines, stripped."""
    return F.filter(F.transform(F.split(text, "\n"), py_strip), lambda s: s != "")


def rule_claim_texts(text: Column, policy: ExtractionPolicy = ExtractionPolicy(), words=HTML_CLAIM_WORDS) -> Column:
    """X03-X07 inside one row: the page's claims in (section, sentence) order,
    at most ``max_rule_claims`` — array functions only, so no shuffle and no
    window (also usable on a stream)."""
    pieces = F.flatten(F.transform(text_sections(text), lambda s: F.transform(sentences(s), py_strip)))
    # fold each piece once, then test the words on the folded copy
    folded = F.transform(pieces, lambda x: F.struct(x.alias("t"), ascii_fold(x).alias("f")))
    kept = F.filter(folded, lambda x: (F.length(x["t"]) >= policy.min_claim_length)
                    & keyword_predicate(x["t"], words, folded=x["f"]))
    return F.slice(F.transform(kept, lambda x: x["t"]), 1, policy.max_rule_claims)


def rule_claims_per_row(pages: DataFrame, keys, text_col: str = "text",
                        policy: ExtractionPolicy = ExtractionPolicy(), words=HTML_CLAIM_WORDS) -> DataFrame:
    """Row-local form of ``rule_claims`` for pages whose sections are the lines
    of ``text_col``; same output columns."""
    keys = list(keys)
    c = spread(pages).select(*keys, F.posexplode(rule_claim_texts(F.col(text_col), policy, words))
                     .alias("claim_pos", "claim_text"))
    return c.select(*keys, "claim_pos", "claim_text", F.lit("html").alias("source"),
                    F.lit(CONFIDENCE_RULES_HTML).alias("confidence"), F.lit(None).cast("string").alias("bbox"),
                    F.lit("unknown").alias("claim_type"), F.lit("").alias("implied_outcome"),
                    F.lit("").alias("quantifier"), has_digit(F.col("claim_text")).alias("has_numeric_quantifier"))


def text_claims(pages: DataFrame, responses: DataFrame | None, keys, text_col: str = "text",
                policy: ExtractionPolicy = ExtractionPolicy(), words=HTML_CLAIM_WORDS) -> DataFrame:
    """X08 + X09 for pages held as one text: model claims where the response
    is valid (pages with at least one section), rule claims elsewhere."""
    policy.check_deterministic()
    keys = list(keys)
    with_secs = pages.where(F.size(text_sections(F.col(text_col))) > 0)
    if not policy.use_model or responses is None:
        return rule_claims_per_row(with_secs, keys, text_col, policy, words).withColumn("path", F.lit("rules"))
    _, ok = parse_response(F.col("body"))
    valid = responses.where(ok).select(*keys).join(with_secs.select(*keys), keys, "left_semi")
    model = (response_claims(responses.join(valid, keys, "left_semi"), keys)
             .where(F.col("claim_pos").isNotNull()).drop("n_claims").withColumn("path", F.lit("model")))
    rules = rule_claims_per_row(with_secs.join(valid, keys, "left_anti"), keys, text_col, policy, words)
    return model.unionByName(rules.withColumn("path", F.lit("rules")))
