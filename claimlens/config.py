"""Rule sets and policies.

The rule sets are small driver-side values: they are compiled into column
expressions (hints, keyword gates, constraints) or turned into tiny DataFrames
(plan strata).  They never hold data, so their size is bounded by the config.
YAML/JSON loaders accept files with the same layout as the defaults.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the original rule files for identical
# results.  Stated plainly and in their original order.
# ---------------------------------------------------------------------------

# Physics/physiology gate hints: id -> patterns (case-insensitive regex search).
PHI_HINTS = (
    ("phi_quantum", (r"\bquantum\b", "scalar energy", "energy field", "bio-energy")),
    ("phi_magnetic", ("magnetic therapy", "magnet(ic)? bracelet", "biomagnetic", "magnetic field healing")),
    ("phi_ionic_detox", ("ionic detox", "detox foot bath", "ion cleanse", "foot spa detox")),
    ("phi_homeopathy", ("homeopathic", r"\b\d+[CX]\b", "oscillococcinum", "ultra-diluted")),
)

# Safety/regulatory gate hints: id -> patterns (case-insensitive regex search).
K_HINTS = (
    ("k_tejocote", ("tejocote", "raiz de tejocote")),
    ("k_colloidal_silver", ("colloidal silver", "sovereign silver", "silver solution", "silver hydrosol")),
    ("k_kratom", ("kratom", "mitragyna speciosa")),
    ("k_germanium", ("germanium", "ge-132")),
    ("k_aristolochic", ("aristolochia", "birthwort")),
)

# Exaggeration tokens and weights (lower-case substring match, in this order).
L_WEIGHTS = (
    ("miracle", 3),
    ("cure", 3),
    ("100%", 2),
    ("instant", 2),
    ("permanent", 2),
    ("guaranteed", 2),
    ("clinically proven", 1),
    ("doctor recommended", 1),
    ("scientifically proven", 1),
    ("FDA approved", 1),
    ("breakthrough", 1),
    ("revolutionary", 1),
)

# Warning list and ingredient aliases (canonical name -> aliases).
FDA_WARNINGS = ("mitragyna speciosa", "colloidal silver", "germanium")
INGREDIENT_ALIASES = (
    ("mitragyna speciosa", ("kratom", "ketum", "thang")),
    ("crataegus pinnatifida", ("tejocote", "mexican hawthorn")),
)

# Claim keywords of the rule-based HTML extractor (regex alternatives, any case).
HTML_CLAIM_WORDS = (
    "proven", "clinically", "guaranteed", "effective", "results",
    "cure", "treat", "prevent", "relieve", "reduce",
    "improve", "boost", "enhance", "support", "promote",
    r"\d+%", "instant", "fast", "quick", "immediate",
)

# Claim keywords of the rule-based OCR extractor (regex alternatives, any case).
OCR_CLAIM_WORDS = (
    "proven", "clinically", "guaranteed", "effective", "results",
    "cure", "treat", "prevent", "miracle", "instant",
    r"\d+%", "100%",
)

# Gate labels of the pattern report, in report order.
REPORT_GATES = (("Φ", "phi"), ("K", "k"), ("L", "l"))

# Gate-hint thresholds: score >= 3 -> l_hard, score > 0 -> l_soft.
L_HARD_MIN = 3

# Representative cohort plan: (name, query, allocation); target 700.
R_TARGET_N = 700
R_STRATA = (
    ("HealthAndHousehold", "site:amazon.com Health & Household", 0.35),
    ("Beauty", "site:amazon.com Beauty hair growth anti-aging", 0.20),
    ("Devices", "site:amazon.com Electric Massagers TENS Pain Relief", 0.15),
    ("Sleep", "site:amazon.com Sleep Aid Melatonin Relaxation", 0.10),
    ("WeightLoss", "site:amazon.com Weight Loss Supplements Fat Burner", 0.10),
    ("HairGrowth", "site:amazon.com Hair Regrowth Hair Growth Products", 0.10),
)
# Targeted cohort plan: (name, keywords, gate); target 300.
T_TARGET_N = 300
T_NODES = (
    ("MagneticTherapy", ("magnetic bracelet", "magnetic therapy", "biomagnetic"), "Φ"),
    ("IonicDetox", ("ionic detox", "detox foot bath", "ion cleanse"), "Φ"),
    ("QuantumPendants", ("quantum pendant", "scalar energy", "energy field", "negative ion"), "Φ"),
    ("Homeopathic", ("homeopathic", "oscillococcinum", "boiron", "dilution 30C"), "Φ"),
    ("ColloidalSilver", ("colloidal silver", "sovereign silver", "silver solution"), "K"),
    ("Tejocote", ("tejocote root", "raiz de tejocote"), "K"),
    ("Kratom", ("kratom", "mitragyna speciosa"), "K"),
    ("MiracleClaims", ("miracle", "cure", "instant", "100% effective", "clinically proven"), "L"),
)
T_MIN_L_SCORE = 3
SAMPLING_FRAME_VERSION = "v2025-11-12"

# Product-id patterns of a product URL, tried in this order (case-sensitive).
PRODUCT_ID_PATTERNS = (r"/dp/([A-Z0-9]{10})", r"/gp/product/([A-Z0-9]{10})", r"/ASIN/([A-Z0-9]{10})")
PRODUCT_URL_PREFIX = "https://www.amazon.com/dp/"
DEFAULT_QUERY_PREFIX = "site:amazon.com "

# Extraction policy values.
EXTRACTION_MODEL = "gemini-2.0-flash-exp"
EXTRACTION_VERSION = "v2025-11-12"
EXTRACTION_TEMPERATURE = 0.0
MIN_CLAIM_LENGTH = 10
MAX_CLAIM_LENGTH = 500
MAX_RULE_CLAIMS_PER_PAGE = 20
OCR_CONFIDENCE_THRESHOLD = 0.7
OCR_TEXT_LIMIT = 500
CLAIM_SIMILARITY_THRESHOLD = 0.85
REVIEW_CONFIDENCE_BELOW = 0.8          # used by the claims table
LOW_CONFIDENCE_THRESHOLD = 0.7         # declared in the policy file, unused there
CONFIDENCE_MODEL_HTML = 0.9
CONFIDENCE_RULES_HTML = 0.6
CONFIDENCE_RULES_OCR = 0.7
CONFIDENCE_MODEL_OCR = 0.75
DESCRIPTION_LIMIT = 2000
APLUS_LIMIT = 1000

# Page-capture policy values.
DOMAIN_WHITELIST = ("www.amazon.com",)
IMAGE_HOST_NEEDLE = "images-amazon.com"
IMAGE_SELECTORS = ("#landingImage", "#main-image", ".a-dynamic-image", "#altImages img",
                   "[data-a-dynamic-image]")
IMAGE_ATTRIBUTES = ("src", "data-old-hires", "data-a-dynamic-image")
MAX_FALLBACK_IMAGES = 5
MAX_ASSETS_PER_PAGE = 10
MAX_PAGES_PER_CATEGORY = 50
MAX_PRODUCTS_PER_SEARCH = 20
SEARCH_DEPTH = 100
RESULTS_PER_KEYWORD = 10
ARCHIVE_HOST = "https://web.archive.org"

# Section selectors of a product page (descendant selectors, first/all match).
SECTION_SELECTORS = (
    ("title", "#productTitle", "first", None),
    ("bullet", "#feature-bullets-btf li span.a-list-item, #feature-bullets li span.a-list-item", "all", None),
    ("description", "#productDescription", "first", DESCRIPTION_LIMIT),
    ("aplus", "[data-template-name] .aplus-module-wrapper", "all", APLUS_LIMIT),
)

# Bundle manifest constants (the bundle name is a label: a parameter of
# ``export.bundle_manifest``, neutral by default).
BUNDLE_NAME = "claims-snapshot"
BUNDLE_VERSION = "v1"
PIPELINE_VERSION = "v1.0"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class HintRules:
    phi: tuple = PHI_HINTS
    k: tuple = K_HINTS
    l_weights: tuple = L_WEIGHTS
    fda_warnings: tuple = FDA_WARNINGS
    ingredient_aliases: tuple = INGREDIENT_ALIASES


@dataclass(frozen=True)
class Stratum:
    name: str
    allocation: float
    query: str | None = None


@dataclass(frozen=True)
class Node:
    name: str
    keywords: tuple
    gate: str = "unknown"
    min_l_score: int | None = None


@dataclass(frozen=True)
class SamplingPlan:
    r_target_n: int = R_TARGET_N
    strata: tuple = tuple(Stratum(n, a, q) for n, q, a in R_STRATA)
    t_target_n: int = T_TARGET_N
    nodes: tuple = tuple(Node(n, k, g, T_MIN_L_SCORE if g == "L" else None) for n, k, g in T_NODES)
    frame_version: str = SAMPLING_FRAME_VERSION


@dataclass(frozen=True)
class ExtractionPolicy:
    use_model: bool = True
    model: str = EXTRACTION_MODEL
    version: str = EXTRACTION_VERSION
    temperature: float = EXTRACTION_TEMPERATURE
    min_claim_length: int = MIN_CLAIM_LENGTH
    max_claim_length: int = MAX_CLAIM_LENGTH
    max_rule_claims: int = MAX_RULE_CLAIMS_PER_PAGE
    ocr_confidence_threshold: float = OCR_CONFIDENCE_THRESHOLD
    use_model_for_ocr_cleanup: bool = False
    similarity_threshold: float = CLAIM_SIMILARITY_THRESHOLD
    review_below: float = REVIEW_CONFIDENCE_BELOW

    def check_deterministic(self):
        """Refuse to run unless the model temperature is exactly 0."""
        if self.temperature != 0:
            raise ValueError("extraction temperature must be 0 (deterministic extraction)")
        return self


@dataclass(frozen=True)
class CapturePolicy:
    domain_whitelist: tuple = DOMAIN_WHITELIST
    archive_enabled: bool = True
    max_pages_per_category: int = MAX_PAGES_PER_CATEGORY
    max_products_per_search: int = MAX_PRODUCTS_PER_SEARCH


def _yaml():
    import yaml  # available on the driver; only used by the loaders
    return yaml


def load_hint_rules(path: str | Path) -> HintRules:
    """Policy hints YAML -> HintRules (order of keys is kept)."""
    doc = _yaml().safe_load(Path(path).read_text())
    phi = tuple((k, tuple(v["patterns"])) for k, v in (doc.get("phi") or {}).items())
    k = tuple((kk, tuple(v["patterns"])) for kk, v in (doc.get("k") or {}).items())
    weights = tuple((str(t), int(w)) for t, w in ((doc.get("l") or {}).get("weights") or {}).items())
    aliases = tuple((c, tuple(a)) for c, a in (doc.get("ingredient_aliases") or {}).items())
    return HintRules(phi, k, weights, tuple(doc.get("fda_warnings") or ()), aliases)


def load_sampling_plan(path: str | Path) -> SamplingPlan:
    """Sampling plan YAML -> SamplingPlan."""
    doc = _yaml().safe_load(Path(path).read_text())
    rep, tgt = doc.get("representative", {}), doc.get("targeted", {})
    strata = tuple(Stratum(s["name"], float(s["allocation"]), s.get("query")) for s in rep.get("strata", []))
    nodes = tuple(Node(n["name"], tuple(n.get("keywords", [])), n.get("gate", "unknown"), n.get("min_l_score"))
                  for n in tgt.get("nodes", []))
    return SamplingPlan(int(rep.get("target_n", 0)), strata, int(tgt.get("target_n", 0)), nodes,
                        doc.get("sampling_frame_version", SAMPLING_FRAME_VERSION))


def load_extraction_policy(path: str | Path) -> ExtractionPolicy:
    """Extraction policy YAML -> ExtractionPolicy."""
    doc = _yaml().safe_load(Path(path).read_text())
    base = ExtractionPolicy()
    return ExtractionPolicy(
        use_model=bool(doc.get("use_llm", base.use_model)),
        model=doc.get("model", base.model),
        temperature=float(doc.get("temperature", base.temperature)),
        min_claim_length=int(doc.get("min_claim_length", base.min_claim_length)),
        max_claim_length=int(doc.get("max_claim_length", base.max_claim_length)),
        ocr_confidence_threshold=float(doc.get("ocr_confidence_threshold", base.ocr_confidence_threshold)),
        use_model_for_ocr_cleanup=bool(doc.get("use_llm_for_ocr_cleanup", False)),
        similarity_threshold=float(doc.get("claim_similarity_threshold", base.similarity_threshold)),
    )


def load_capture_policy(path: str | Path) -> CapturePolicy:
    """Page-capture policy YAML -> CapturePolicy."""
    doc = _yaml().safe_load(Path(path).read_text())
    return CapturePolicy(tuple(doc.get("domain_whitelist", DOMAIN_WHITELIST)), bool(doc.get("wayback_save", True)),
                         int(doc.get("max_pages_per_category", MAX_PAGES_PER_CATEGORY)),
                         int(doc.get("max_products_per_search", MAX_PRODUCTS_PER_SEARCH)))


def load_table_schema(path: str | Path) -> dict:
    """JSON constraint document (compiled by ``operators.quality``)."""
    return json.loads(Path(path).read_text())
