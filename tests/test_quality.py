"""Negative controls: every check must fail on a mutated row."""

from pyspark.sql import functions as F

from claimlens.operators import quality
from claimlens.plans.q_quality import claims_with_defects, products_table
from claimlens.schemas import ASSETS_SCHEMA, CLAIMS_SCHEMA, PRODUCT_SCHEMA
from conftest import SF_SMALL


def test_seeded_claim_defects_are_reported(spark):
    c = claims_with_defects(spark, SF_SMALL)
    v = quality.violations(c, CLAIMS_SCHEMA, "claims")
    hit = {(r["row_ord"], r["column"], r["rule"]) for r in v.collect()}
    assert (1, "page_sha256", "type") in hit           # seq 0: null hash
    assert (2, "extraction_temperature", "enum") in hit  # seq 1: temperature 0.7
    assert (3, "claim_type", "enum") in hit            # seq 2: outside the list
    assert (4, "claim_text_verbatim", "minLength") in hit
    assert (5, "asin", "pattern") in hit
    t = {r["row_ord"] for r in quality.temperature_check(c).collect()}
    assert 2 in t and 52 in t
    req = {(r["row_ord"], r["field"]) for r in quality.required_fields(c, ["page_sha256", "claim_sha256"]).collect()}
    assert (1, "page_sha256") in req


def test_clean_products_pass_and_mutations_fail(spark):
    p, _ = products_table(spark, SF_SMALL)
    assert quality.violations(p, PRODUCT_SCHEMA, "products").count() == 0
    bad = p.withColumn("sampling_cohort", F.when(F.col("row_ord") == 1, F.lit("X")).otherwise(F.col("sampling_cohort")))
    bad = bad.withColumn("price", F.when(F.col("row_ord") == 2, F.lit(-1.0)).otherwise(F.col("price")))
    got = {(r["row_ord"], r["column"], r["rule"]) for r in quality.violations(bad, PRODUCT_SCHEMA, "products").collect()}
    assert got == {(1, "sampling_cohort", "enum"), (2, "price", "minimum")}
    missing = quality.violations(p.drop("platform"), PRODUCT_SCHEMA, "products")
    assert missing.where("rule = 'required' AND column = 'platform'").count() == p.count()


def test_suffix_coercion_rejects_every_claim_row(spark):
    c = claims_with_defects(spark, SF_SMALL)
    v = quality.row_errors(quality.violations(c, CLAIMS_SCHEMA, "claims", coercion="suffix"))
    assert v.count() == c.count()


def test_asset_rules(spark):
    a = spark.createDataFrame([(1, "P000000001", "P000000001_img00", "image", "u", "a" * 64, -3),
                               (2, "bad", "x", "video", "u", "xyz", 5)],
                              "row_ord long, asin string, asset_id string, asset_type string, url string, "
                              "sha256 string, width int")
    got = {(r["row_ord"], r["column"], r["rule"]) for r in quality.violations(a, ASSETS_SCHEMA, "assets").collect()}
    assert got == {(1, "width", "minimum"), (2, "asin", "pattern"), (2, "asset_type", "enum"),
                   (2, "sha256", "pattern")}


def test_summary_counts_and_samples(spark):
    errs = spark.createDataFrame([(i,) for i in (9, 3, 7, 1, 5, 11)], "row_ord long")
    none = spark.createDataFrame([], "row_ord long")
    s = {r["check"]: r for r in quality.summary(spark, [("a", errs), ("b", none)]).collect()}
    assert s["a"]["n_errors"] == 6 and s["a"]["first_rows"] == "1,3,5,7,9" and not s["a"]["passed"]
    assert s["b"]["passed"] and s["b"]["n_errors"] == 0


def test_suffix_coercion_reads_cells_as_columns(spark):
    doc = {"required": ["a_score", "flag"], "properties": {
        "a_score": {"type": ["integer", "null"], "enum": [1, 7], "minimum": 2}, "a_weight": {"type": ["number", "null"], "maximum": 2},
        "flag": {"type": "boolean", "enum": [True]}, "word": {"type": ["string", "null"], "pattern": "^[a-z]+$", "minLength": 2},
        "price": {"type": ["integer", "null"], "minimum": 0}}}
    df = spark.createDataFrame([(1, "7", "1.5", "true", "abc", "3.0"), (2, " 1 ", "x", "false", "true", "-1"), (3, "1.5", "2.5", "", "", ""),
                                (4, None, None, None, "a", "2.5"), (5, "99999999999999999999", "NaN", "TRUE", "A1", "1e2")],
                               "row_ord long, a_score string, a_weight string, flag string, word string, price string")
    v = quality.violations(df, doc, "t", coercion="suffix")
    assert sorted((r["row_ord"], r["column"], r["rule"]) for r in v.collect()) == [
        (2, "a_score", "minimum"), (2, "a_weight", "type"), (2, "flag", "enum"), (2, "price", "minimum"), (2, "word", "type"),
        (3, "a_score", "enum"), (3, "a_score", "type"), (3, "a_weight", "maximum"), (3, "flag", "enum"), (3, "flag", "type"),
        (4, "a_score", "enum"), (4, "flag", "enum"), (4, "flag", "type"), (4, "price", "type"), (4, "word", "minLength"),
        (5, "a_score", "enum"), (5, "a_score", "type"), (5, "a_weight", "maximum"), (5, "flag", "enum"), (5, "flag", "type"), (5, "word", "pattern")]
    # no per-cell lambda, which Spark interprets and in which a type was read up to five times
    plan = v._jdf.queryExecution().optimizedPlan().toString()
    assert "_v_word" in plan and "transform(" not in plan
