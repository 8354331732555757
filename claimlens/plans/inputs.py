"""Inputs of the registered queries, derived by Spark from the given tables.

The supplied tables hardly contain the rule vocabulary, so several inputs are
deterministic derivations (the same recipes are written in DuckDB SQL in
``oracle.py``).  Every derivation is a projection of whole tables: the work
grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import ExtractionPolicy
from ..functions.text import has_digit, py_strip, zero_pad
from ..operators import extract
from ..session import spread, written

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# FIXED FIXTURE VALUES (ours): phrases that follow the sentences of the derived
# claims relation, chosen so that every hint id and exaggeration token fires.
FX_TEMPLATES = (
    "quantum resonance cushion",
    "scalar energy card",
    "magnetic therapy insole",
    "a Magnet bracelet for knees",
    "ionic detox session",
    "take 30C pellets nightly",
    "homeopathic drops",
    "tejocote extract",
    "colloidal silver spray",
    "KRATOM tea blend",
    "germanium capsules",
    "birthwort tincture",
    "quantum kratom mix",
    "a secure fit for your insole",
    "instantly calmer evenings",
    "cure guaranteed 100%",
    "miracle breakthrough",
    "permanent revolutionary relief",
    "clinically proven comfort",
    "doctor recommended and scientifically proven",
    "made in an FDA approved facility",
    "soft cotton cover",
    "supports deep sleep in 14 days",
    "quantumly speaking, a 30CX label",
)

# FIXED FIXTURE VALUES (ours): a dense keyword list for the prose in
# ``documents`` (the original claim words hit only a few documents).
DENSE_LEXICON = ("tion", "ment", "ung", "the")

# FIXED FIXTURE VALUES (ours): model-response bodies by doc_id % their number;
# ``@`` stands for the document's text.
RESPONSE_BODIES = (
    '[{"text":"@","claim_type":"safety"},{"text":"b"}]',
    "[]",
    "not json",
    '{"text":"@"}',
    '[{"text":"@"},"x"]',
    '[{"text":null}]',
    '[{"text":"@"}] trailing',
    None,
    '[{"text":"@"},null]',
    "[{'text':'@'}]",
    '[{"text":"@"}] junk [1]',
    '[{"text":"@"}][{"text":"b"}]',
    '[{text:"@"}]',
    ' [{"text":"padded"}] ',
)

# What a JSON string cannot hold as it is.
JSON_UNSAFE = r'[\x00-\x1f"\\]'

# FIXED FIXTURE VALUES (ours): OCR confidences by word index % 5, and the
# OCR cleanup responses by doc_id % 4.
OCR_CONFS = ("96.5", "70", "70.5", "-1", "n/a")
OCR_CLEANUP_BODIES = ('[{"text":"cleaned claim","claim_type":"efficacy","quantifier":"20%"}]', "[]", "oops", None)

# FIXED FIXTURE VALUES (ours): weights plan over customer segments.
SEGMENT_ALLOCATIONS = (("AUTOMOBILE", 0.30), ("BUILDING", 0.25), ("FURNITURE", 0.20), ("HOUSEHOLD", 0.15))

# FIXED FIXTURE VALUES (ours): strata of the page-derived search results.
LANG_STRATA = (("en", 0.35), ("fr", 0.25), ("de", 0.20), ("es", 0.20))
TLD_KEYWORDS = ("com", "net", "org")
T_FIXTURE_TARGET = 100
PAGE_ID_PATTERN = r"/(?:en|fr|de|es)/([0-9]+)"
LANG_PATTERN = r"/(en|fr|de|es)/[0-9]+"
HOST_PATTERN = r"^[a-z]+://([^/:?#]+)"
CAPTURE_EPOCH_US = 1762905600 * 1000000  # 2025-11-12T00:00:00Z


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _div(c: str, n: int):
    return F.floor(F.col(c) / F.lit(n)).cast("long")


def derived_claims(documents: DataFrame) -> DataFrame:
    """The claims fixture ``fx``: the sentences of every document that hit the
    dense lexicon (X03-X07), each followed by a phrase; 5 documents per product."""
    phrases = F.array(*[F.lit(t) for t in FX_TEMPLATES])
    pages = documents.select("doc_id", F.sha2(F.col("text"), 256).alias("page_hash"), "text")
    c = extract.rule_claims_per_row(pages, ["doc_id", "page_hash"], "text", ExtractionPolicy(), words=DENSE_LEXICON)
    phrase = F.element_at(phrases, ((F.col("doc_id") + F.col("claim_pos")) % len(FX_TEMPLATES)).cast("int") + 1)
    c = c.select("doc_id", "page_hash", (F.col("doc_id") * ExtractionPolicy().max_rule_claims + F.col("claim_pos")).alias("claim_ord"),
                 F.concat_ws(" ", "claim_text", phrase).alias("claim_text"))
    n = F.col("claim_ord")
    return c.select(
        "claim_ord",
        F.concat(F.lit("K"), zero_pad(_div("doc_id", 5), 9)).alias("product_key"),
        "claim_text",
        F.when(n % 4 == 0, 0.9).when(n % 4 == 1, 0.6).when(n % 4 == 2, 0.7).otherwise(0.75).alias("confidence"),
        F.when(n % 4 == 2, "image").otherwise("html").alias("origin"),
        F.when(_div("doc_id", 5) % 4 == 0, "T").otherwise("R").alias("cohort"),
        "page_hash")


def raw_records(fx: DataFrame) -> DataFrame:
    """X16 over ``fx``: one nested record per (product, origin) in first-claim
    order, carrying the claims in claim order."""
    claim = F.struct(
        F.col("claim_text").alias("text"), F.col("origin").alias("source"), F.col("confidence"),
        F.when(F.col("origin") == "image", F.lit("[[0, 0, 10, 10]]")).alias("bbox"),
        F.when(F.col("claim_ord") % 3 == 0, "efficacy").when(F.col("claim_ord") % 3 == 1, "safety")
         .alias("claim_type"),
        F.lit("").alias("implied_outcome"), F.lit("").alias("quantifier"),
        has_digit(F.col("claim_text")).alias("has_numeric_quantifier"),
        F.regexp_extract("claim_text", "([0-9]+)", 1).alias("quant_value"),
        F.when(F.col("claim_ord") % 3 == 1, "mg").alias("quant_unit"),
        F.when(F.col("claim_ord") % 5 == 0, "placebo").alias("comparator"))
    g = fx.groupBy(F.col("product_key").alias("asin"), F.col("origin").alias("source")).agg(
        F.min("claim_ord").alias("rec_ord"), F.min_by("page_hash", "claim_ord").alias("page_sha256"),
        F.array_sort(F.collect_list(F.struct(F.col("claim_ord"), claim.alias("c")))).alias("_items"))
    return g.select(
        "rec_ord", "asin",
        F.when(F.col("source") == "html", F.concat("asin", F.lit("_html")))
         .otherwise(F.concat("asin", F.lit("_img00"))).alias("asset_id"),
        "source",
        F.struct(F.lit("gemini-2.0-flash-exp").alias("model"), F.lit("v2025-11-12").alias("version"),
                 F.lit(0.0).alias("temperature")).alias("extraction"),
        F.transform("_items", lambda x: x["c"]).alias("claims"), "page_sha256")


def written_records(documents: DataFrame) -> DataFrame:
    """The records of all documents' claims as a table: extraction writes them,
    normalisation reads them (several times)."""
    return written(raw_records(derived_claims(documents)), "records")


def url_meta(documents: DataFrame) -> DataFrame:
    """URL-frame rows for the products of ``fx``: one row per non-German
    document (so a product can have several rows, the last wins, and products
    whose documents are all German have no match)."""
    d = F.col("doc_id")
    cohort = F.when(_div("doc_id", 5) % 4 == 0, "T").otherwise("R")
    return documents.where(F.col("lang") != "de").select(
        d.alias("frame_ord"), F.concat(F.lit("K"), zero_pad(_div("doc_id", 5), 9)).alias("asin"),
        cohort.alias("cohort"), F.when(cohort == "T", "keyword").otherwise("random").alias("method"),
        F.initcap(F.col("lang")).alias("category_hint"))


def document_sections(documents: DataFrame) -> DataFrame:
    """Documents as pages: every non-blank line is a bullet section."""
    lines = spread(documents).select("doc_id", F.posexplode(F.split(F.col("text"), "\n")).alias("sec_ord", "line"))
    return lines.select("doc_id", "sec_ord", F.lit("bullet").alias("section"),
                        py_strip(F.col("line")).alias("text")).where(F.col("text") != "")


def model_responses(documents: DataFrame) -> DataFrame:
    """Model answers about the documents, with their whole texts as claims."""
    bodies = F.array(*[F.lit(b) for b in RESPONSE_BODIES])
    body = F.element_at(bodies, (F.col("doc_id") % len(RESPONSE_BODIES)).cast("int") + 1)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), JSON_UNSAFE, " ")
    return documents.select("doc_id", F.replace(body, F.lit("@"), text).alias("body"))


def ocr_words(documents: DataFrame) -> DataFrame:
    """Documents as OCR output: words split on spaces, one image per document."""
    w = spread(documents).select(
        "doc_id", F.concat(F.lit("D"), zero_pad(F.col("doc_id"), 9), F.lit("_img00")).alias("asset_id"),
                         F.posexplode(F.split(F.col("text"), " ")).alias("idx", "text"))
    confs = F.array(*[F.lit(c) for c in OCR_CONFS])
    return w.select(
        "asset_id", F.col("idx").cast("int").alias("idx"),
        "text", F.element_at(confs, (F.col("idx") % 5).cast("int") + 1).alias("conf"),
        (F.col("idx") * 10).cast("int").alias("left"), (F.col("doc_id") % 100).cast("int").alias("top"),
        (F.length("text") * 7).cast("int").alias("width"), F.lit(12).alias("height"))


def ocr_cleanup(documents: DataFrame) -> DataFrame:
    bodies = F.array(*[F.lit(b) for b in OCR_CLEANUP_BODIES])
    return documents.select(F.concat(F.lit("D"), zero_pad(F.col("doc_id"), 9), F.lit("_img00")).alias("asset_id"),
                            F.element_at(bodies, (F.col("doc_id") % 4).cast("int") + 1).alias("body"))


def captures(pages: DataFrame) -> DataFrame:
    """Capture log from pages: status by page_id % 7, empty body every 11th page,
    capture time = 2025-11-12 + page_id seconds (+ micro-seconds on odd pages)."""
    p = F.col("page_id")
    status = F.when(p % 7 == 0, 404).when(p % 7 == 1, 0).otherwise(200)
    ts = F.timestamp_micros(F.lit(CAPTURE_EPOCH_US) + p * 1000000 + (p % 2) * 250000)
    return pages.select(
        p.alias("page_ord"), F.regexp_extract("url", PAGE_ID_PATTERN, 1).alias("asin"), "url",
        status.cast("int").alias("status_code"),
        F.when(p % 11 == 0, F.lit("")).otherwise(F.col("html")).alias("html"), ts.alias("captured_at"))


def search_results_r(pages: DataFrame) -> DataFrame:
    """Representative search results: stratum = URL language, rank = page_id."""
    return pages.select(F.regexp_extract("url", LANG_PATTERN, 1).alias("stratum"),
                        F.col("page_id").alias("rank"), F.col("url").alias("link"))


def search_results_t(pages: DataFrame) -> DataFrame:
    """Targeted search results: node = URL language, keyword = top-level domain
    (order com, net, org), rank = page_id."""
    host = F.regexp_extract("url", HOST_PATTERN, 1)
    kw = F.regexp_extract(host, r"\.([a-z]+)$", 1)
    order = F.array_position(F.array(*[F.lit(k) for k in TLD_KEYWORDS]), kw).cast("int")
    return pages.select(F.regexp_extract("url", LANG_PATTERN, 1).alias("node"), kw.alias("keyword"),
                        order.alias("keyword_ord"), F.col("page_id").alias("rank"), F.col("url").alias("link")) \
                .where(F.col("keyword_ord") > 0)


def customer_frame(customer: DataFrame) -> DataFrame:
    """Weighting frame: cohort R unless c_custkey % 4 = 0, stratum = segment."""
    return customer.select(F.col("c_custkey").alias("key"),
                           F.when(F.col("c_custkey") % 4 == 0, "T").otherwise("R").alias("cohort"),
                           F.col("c_mktsegment").alias("stratum"))


def access_rules(pages: DataFrame) -> DataFrame:
    """One rule per host seen in pages: allowed iff the host starts with
    ``blog.``; hosts starting with ``m.`` get no rule (denied)."""
    host = F.lower(F.regexp_extract("url", HOST_PATTERN, 1))
    return pages.select(host.alias("host")).where(~F.col("host").startswith("m.")).distinct() \
                .select("host", F.col("host").startswith("blog.").alias("allowed"))


def archive_answers(pages: DataFrame) -> DataFrame:
    """Archive service answers: 503 every 5th page; location absent, relative
    or absolute by page_id % 3."""
    p = F.col("page_id")
    status = F.when(p % 5 == 0, 503).otherwise(200)
    location = (F.when(p % 3 == 0, F.lit(None).cast("string"))
                 .when(p % 3 == 1, F.concat(F.lit("/web/20251112000000/"), F.col("url")))
                 .otherwise(F.concat(F.lit("https://web.archive.org/web/20251112000001/"), F.col("url"))))
    return pages.select("page_id", "url", status.alias("archive_status"), location.alias("location"))


def image_pages(pages: DataFrame) -> DataFrame:
    """Pages with <img> markup appended (the supplied pages have none):
    page_id % 4 = 0 selector hits with duplicates, a protocol-relative URL, a
    host outside the needle and a JSON attribute; 1 fallback images with a
    duplicate and an empty src; 2 a broken JSON attribute and 12 gallery images
    (cap 10); 3 nothing."""
    i = F.col("page_id").cast("string")
    p0 = F.concat(
        F.lit('<img id="landingImage" alt="main" src="https://m.media-amazon.com/images/I/'), i,
        F.lit('.jpg" data-old-hires="https://images-amazon.com/images/I/'), i,
        F.lit('L.jpg" data-a-dynamic-image=\'{"https://images-amazon.com/images/I/'), i,
        F.lit('D.jpg":[500,500],"https://images-amazon.com/images/I/'), i,
        F.lit('S.jpg":[100,100]}\'><div id="altImages"><img src="//images-amazon.com/images/I/'), i,
        F.lit('L.jpg"><img src=""><img src="/local/'), i, F.lit('.png"></div>'))
    p1 = F.concat(F.lit('<div><img src="a'), i, F.lit('.png" alt="a"><img src=""><img src="a'), i,
                  F.lit('.png"><img src="b.png"><img src="c.png"><img src="d.png"><img src="e.png"></div>'))
    gallery = F.concat(*[F.concat(F.lit(f'<img src="https://images-amazon.com/g/{k}-'), i, F.lit('.jpg">'))
                         for k in range(12)])
    p2 = F.concat(F.lit('<img class="a-dynamic-image" data-a-dynamic-image="not json" '
                        'src="https://images-amazon.com/x/'), i, F.lit('.jpg"><div id="altImages">'), gallery,
                  F.lit("</div>"))
    k = F.col("page_id") % 4
    extra = F.when(k == 0, p0).when(k == 1, p1).when(k == 2, p2).otherwise(F.lit(""))
    return pages.select("page_id", "url", F.concat(F.col("html"), extra).alias("html"))


# Section mapping of the supplied pages (title, bullets, description).
PAGE_SECTION_RULES = (
    ("title", "article h1", "first", None),
    ("bullet", "nav li", "all", None),
    ("description", "article p", "first", 2000),
)
