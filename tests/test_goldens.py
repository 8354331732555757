"""Hand-computed goldens (FIXTURES.md §6) and edge rows."""

from pyspark.sql import functions as F

from claimlens.config import HintRules
from claimlens.functions import hints, html_parse
from claimlens.functions.jsontext import json_list_text
from claimlens.functions.text import grouped_alternation, keyword_predicate, py_strip, required
from claimlens.operators import extract, frame, normalize, report, weights
from claimlens.plans.inputs import FX_TEMPLATES


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_quota_double_truncation(spark):
    df = spark.createDataFrame([(a,) for a in (0.35, 0.20, 0.15, 0.10, 0.10, 0.10)], "a double")
    q700 = [r[0] for r in df.select(frame.stratum_quota(700, F.col("a"))).collect()]
    q50 = [r[0] for r in df.select(frame.stratum_quota(50, F.col("a"))).collect()]
    assert q700 == [244, 140, 105, 70, 70, 70] and sum(q700) == 699
    assert q50 == [17, 10, 7, 5, 5, 5]
    assert spark.range(1).select(frame.node_quota(300, 8)).first()[0] == 37


def test_placeholder_ids(spark):
    q = spark.createDataFrame([("HealthAndHousehold", 0, 2), ("Beauty", 1, 0), ("Sleep", 2, 1)],
                              "stratum string, stratum_ord int, quota int")
    out = sorted(rows(frame.expand_slots(spark, q, "R"), "asin", "slot_ord"))
    assert out == [("RHEA00000", 0), ("RHEA00001", 1), ("RSLE00000", 0)]


def test_product_id_patterns(spark):
    df = spark.createDataFrame([("/x/dp/B000000001/gp/product/B000000002",), ("/gp/product/B000000003",),
                                ("/dp/b000000001",), ("/ASIN/C000000004?x",)], "u string")
    got = [r[0] for r in df.select(frame.extract_product_id(F.col("u"))).collect()]
    assert got == ["B000000001", "B000000003", "", "C000000004"]


def test_sentence_split_and_strip(spark):
    df = spark.createDataFrame([(1, 0, "t", "a. b!! c? 3.5% x.")], "doc_id long, sec_ord int, section string, text string")
    got = [r["claim_text"] for r in extract.split_sentences(df, ["doc_id"]).orderBy("sent_ord").collect()]
    assert [g for g in got if g] == ["a", "b", "c", "3", "5% x"]


def test_py_strip_unicode(spark):
    s = "　\x1c x  \x85"
    assert spark.range(1).select(py_strip(F.lit(s))).first()[0] == s.strip()


def test_keyword_gate_is_substring_and_case_insensitive(spark):
    words = ("cure", "fast", r"\d+%")
    texts = ["a secure fit", "BREAKFAST time", "50% off", "nothing here", "ſecure"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(keyword_predicate(F.col("t"), words)).collect()]
    import re
    exp = [bool(re.search("|".join(words), t, re.IGNORECASE)) for t in texts]
    assert got == exp


def test_rule_claims_cap_and_order(spark):
    text = ". ".join(f"proven claim number {i}" for i in range(30))
    df = spark.createDataFrame([(1, 0, "description", text)], "doc_id long, sec_ord int, section string, text string")
    c = extract.rule_claims(df, ["doc_id"]).orderBy("claim_pos").collect()
    assert len(c) == 20 and c[0]["claim_text"] == "proven claim number 0" and c[19]["claim_pos"] == 19
    per_row = extract.rule_claims_per_row(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                                          ["doc_id"], "text").orderBy("claim_pos").collect()
    assert [r["claim_text"] for r in per_row] == [r["claim_text"] for r in c]


def test_exaggeration_score_readme_example(spark):
    df = spark.createDataFrame([("Miracle cure with 100% instant results",)], "t string")
    r = df.select(hints.l_tokens(F.col("t")).alias("tok"), hints.l_score(F.col("t")).alias("s")).first()
    assert r["tok"] == ["miracle", "cure", "100%", "instant"] and r["s"] == 10


def test_gate_precedence(spark):
    df = spark.createDataFrame([(t,) for t in FX_TEMPLATES], "t string")
    t = F.col("t")
    out = rows(df.select("t", hints.gate_hint(hints.phi_hint_ids(t), hints.k_hint_ids(t), hints.l_score(t)).alias("g")),
               "t", "g")
    d = dict(out)
    assert d["quantum kratom mix"] == "k_candidate"
    assert d["a secure fit for your insole"] == "l_hard"
    assert d["instantly calmer evenings"] == "l_soft"
    assert d["quantumly speaking, a 30CX label"] == "none"
    assert d["take 30C pellets nightly"] == "phi_candidate"
    fired = df.select(F.explode(F.concat(hints.phi_hint_ids(t), hints.k_hint_ids(t))).alias("h")).distinct().count()
    assert fired == 9
    toks = df.select(F.explode(hints.l_tokens(t))).distinct().count()
    assert toks == len(HintRules().l_weights)


def test_json_list_text_matches_python(spark):
    import json
    vals = [["a", "b"], [], ["é", 'q"u', "back\\slash", "tab\t", "😀"]]
    df = spark.createDataFrame([(v,) for v in vals], "a array<string>")
    got = [r[0] for r in df.select(json_list_text(F.col("a"))).collect()]
    assert got == [json.dumps(v) for v in vals]


def test_global_claim_ids_and_review_flag(spark):
    raw = spark.createDataFrame(
        [(0, "K000000000", "K000000000_html", "html", ("m", "v", 0.0),
          [("first claim text", "html", 0.9, None, "efficacy", "", "", False),
           ("second claim text", "html", 0.75, None, None, "", "", False)], "h" * 64),
         (1, "K000000001", "K000000001_html", "html", ("m", "v", 0.0),
          [("third claim text", "html", 0.8, None, "safety", "", "", False)], "g" * 64)],
        "rec_ord long, asin string, asset_id string, source string, "
        "extraction struct<model:string,version:string,temperature:double>, "
        "claims array<struct<text:string,source:string,confidence:double,bbox:string,claim_type:string,"
        "implied_outcome:string,quantifier:string,has_numeric_quantifier:boolean>>, page_sha256 string")
    c = normalize.build_claims(raw).orderBy("claim_seq").collect()
    assert [r["claim_id"] for r in c] == ["K000000000_c0000", "K000000000_c0001", "K000000001_c0002"]
    assert [r["review_needed"] for r in c] == [False, True, False]
    assert c[1]["claim_type"] == "efficacy"      # the default of an absent key


def test_initial_weight_by_cohort(spark):
    raw = spark.createDataFrame(
        [(i, k, "x", "html", ("m", "v", 0.0), [], "h") for i, k in enumerate(["A", "B", "C"])],
        "rec_ord long, asin string, asset_id string, source string, "
        "extraction struct<model:string,version:string,temperature:double>, "
        "claims array<struct<text:string,source:string,confidence:double,bbox:string,claim_type:string,"
        "implied_outcome:string,quantifier:string,has_numeric_quantifier:boolean>>, page_sha256 string")
    meta = spark.createDataFrame([("A", "R", "random", "S"), ("B", "T", "keyword", "S")],
                                 "asin string, cohort string, method string, category_hint string")
    claims = normalize.build_claims(raw)
    p = {r["asin"]: r for r in normalize.build_products(raw, claims, meta).collect()}
    assert (p["A"]["sampling_weight"], p["B"]["sampling_weight"], p["C"]["sampling_weight"]) == (1.0, None, None)
    assert p["C"]["sampling_cohort"] == "R" and p["C"]["selection_method"] == "random"
    assert p["A"]["l_max_token_score"] == 0 and p["A"]["phi_any_candidate"] is False


def test_unknown_stratum_weight(spark):
    fr = spark.createDataFrame([(i, "R", "unknown") for i in range(7)], "key long, cohort string, stratum string")
    plan = spark.createDataFrame([(f"s{i}", 0.1) for i in range(6)], "stratum string, allocation double")
    w = weights.stratum_weights(fr, plan)
    assert [r["weight"] for r in w.collect()] == [0.1667]


def test_report_ties_by_first_appearance(spark):
    c = spark.createDataFrame([(1, ["phi_b"], [], []), (2, ["phi_a"], [], []), (3, ["phi_a", "phi_b"], [], [])],
                              "row_ord long, phi_hint_ids array<string>, k_hint_ids array<string>, l_tokens array<string>")
    out = rows(report.pattern_counts(c).orderBy("report_pos"), "pattern", "count")
    assert out == [("phi_b", 2), ("phi_a", 2)]


def test_html_text_no_separator_and_implied_ends():
    root = html_parse.parse("<div id='productDescription'><p>goals.</p><p>Now</p></div>")
    (el,) = html_parse.select(root, html_parse.compile_selector("#productDescription"))
    assert el.text() == "goals.Now"
    root = html_parse.parse("<article><p><b>one<p>two<script>var s='</p>x';</script></article>")
    ps = html_parse.select(root, html_parse.compile_selector("article p"))
    assert [p.text() for p in ps] == ["one", "two"]


def test_image_candidates_order_json_and_fallback():
    html = ('<img id="landingImage" src="/a.jpg" data-old-hires="https://images-amazon.com/x.jpg" '
            'data-a-dynamic-image=\'{"https://images-amazon.com/d.jpg":[1,1]}\'>'
            '<div id="altImages"><img src="//images-amazon.com/x.jpg"></div>')
    c = html_parse.image_candidates(html, "https://www.example.com/p/1",
                                    [html_parse.compile_selector(s) for s in ("#landingImage", "#altImages img")],
                                    ("src", "data-old-hires", "data-a-dynamic-image"))
    tier1 = [u for t, _, u, _, _ in c if t == 1]
    assert tier1 == ["https://www.example.com/a.jpg", "https://images-amazon.com/x.jpg",
                     "https://images-amazon.com/d.jpg", "https://images-amazon.com/x.jpg"]
    assert [s for t, _, _, s, _ in c if t == 2] == ["/a.jpg", "//images-amazon.com/x.jpg"]


def test_select_assets_fallback_and_cap(spark):
    cand = spark.createDataFrame(
        [("P1", 1, i, f"https://images-amazon.com/{i % 12}.jpg", None, "") for i in range(14)] +
        [("P2", 1, 0, "https://other.com/a.jpg", None, ""),
         ("P2", 2, 0, "https://w/a.png", "a.png", ""), ("P2", 2, 1, None, "", ""),
         ("P2", 2, 2, "https://w/a.png", "a.png", ""), ("P2", 2, 3, "https://w/b.png", "b.png", "")],
        "asin string, tier int, pos int, url string, raw_src string, alt string")
    from claimlens.operators.pages import select_assets
    a = select_assets(cand, "asin")
    got = {k: [r["url"] for r in a.where(F.col("asin") == k).orderBy("asset_pos").collect()] for k in ("P1", "P2")}
    assert len(got["P1"]) == 10 and got["P1"][0].endswith("/0.jpg")
    assert got["P2"] == ["https://w/a.png", "https://w/b.png"]
    ids = [r["asset_id"] for r in a.where(F.col("asin") == "P2").orderBy("asset_pos").collect()]
    assert ids == ["P2_img00", "P2_img01"]


def test_model_answers_are_valid_exactly_when_json_loads_says_so(spark):
    import json
    from pyspark.sql import functions as F
    from claimlens.operators.extract import parse_response
    bodies = ['[{"text":"a"}]', "[]", ' [{"a":1}] ', '[{"text":"a"},null]', "[{'text':'a'}]", '[{"text":"a"}] junk [1]', '[{"text":"a"}][{"text":"b"}]',
              '[{text:"a"}]', '{"text":"a"}', '[{"text":"a"},"x"]', "not json", "", '[{"x":NaN}]', "[null]"]

    def valid(body):
        try:
            got = json.loads(body)
        except ValueError:
            return False
        return isinstance(got, list) and all(isinstance(x, dict) for x in got)

    rows = spark.createDataFrame([(b,) for b in bodies], "body string").select("body", parse_response(F.col("body"))[1].alias("ok")).collect()
    assert {r.body: r.ok for r in rows} == {b: valid(b) for b in bodies}


def test_deep_pages_do_not_raise():
    from claimlens.functions.html_parse import parse
    root = parse("<b>" * 3000 + "x")
    assert root.text() == "x" and sum(1 for _ in root.iter()) == 3000


def test_hint_patterns_equal_their_regexes(spark):
    """Substring tests and guarded regexes find what each rule's plain regex finds."""
    rules = HintRules(phi=HintRules().phi + (("odd", (r"x{2}y+z?", "[^a]b|c d", r"\x41\d", "(?=q)q", "Kilo")), ("every", ())))
    words = [p for _, ps in rules.phi + rules.k for p in ps] + ["1C", "12x", "٣C", "a1C", "xxyy", "magnet bracelet", "magnetic bracelet", "A7", "q", "b"]
    odd = str.maketrans({"i": "İ", "s": "ſ", "k": "\u212a"}), str.maketrans({"i": "ı", "o": "ö", "a": "A\u0301"})
    texts = [None, ""] + [f(f"é {w} {t}") for w in words for t in ("", "Σ") for f in (str, str.upper, str.title, lambda x: x.translate(odd[0]), lambda x: x.translate(odd[1]))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    def plain(text, of):
        return F.array_compact(F.array(*[F.when(text.rlike(grouped_alternation(ps)), F.lit(i)) for i, ps in of]))
    t = F.col("t")
    got = hints.with_hints(df.withColumn("p", plain(t, rules.phi)).withColumn("k", plain(F.concat(t, F.lit(" ")), rules.k)), "t", rules=rules)
    got = got.withColumn("p2", hints.phi_hint_ids(t, rules)).withColumn("k2", hints.k_hint_ids(t, None, rules)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["phi_hint_ids"] == r["p2"] == r["p"] and r["k_hint_ids"] == r["k2"] == r["k"], r
    assert {h for r in got for h in r["p"]} == {i for i, _ in rules.phi}


def test_required_part_of_a_pattern():
    assert required("magnet(ic)? bracelet") == (" bracelet", False) and required(r"\b\d+[CX]\b") == ("", True)
    assert required("abc?d*") == ("ab", False) and required("a|bcd") == ("", False) and required(r"\x41bc") == ("", False)
    assert required(r"(a|b)\d?x{0}Yz") == ("yz", False) and required("(?i)abc") == ("", False) and required("a[bc]de") == ("de", False)
