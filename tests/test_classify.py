"""Claim classification (D10): units by position, precedence, odd texts."""

import pytest

from claimlens.operators import classify

CLAIMS = [
    ("Reduces pain by 87% vs placebo", ("efficacy", "pain_relief", "87%", True, "87", "%", "vs placebo")),
    ("supports deep sleep in 14 days", ("efficacy", "sleep_quality", "14 days", True, "14", "days", "")),
    ("2 pills, 500 mg each", ("efficacy", "other", "500 mg", True, "500", "mg", "")),
    ("mg 5 days", ("efficacy", "other", "5 days", True, "5", "days", "")),
    ("take 1,000.5 now", ("efficacy", "other", "1,000.5", True, "1,000.5", "", "")),
    ("5 a b c days", ("efficacy", "other", "5", True, "5", "", "")),
    ("5 a b days", ("efficacy", "other", "5 days", True, "5", "days", "")),
    ("stronger than steel, 3 x better compared with the rest", ("efficacy", "other", "3 x", True, "3", "x", "than steel")),
    ("safe cure for hair and heart", ("safety", "hair_growth", "", False, "", "", "")),
    ("treats memory better than", ("medical", "cognitive", "", False, "", "", "than")),
    ("compared prices", ("efficacy", "other", "", False, "", "", "")),
    ("", ("efficacy", "other", "", False, "", "", "")),
    (None, ("efficacy", "other", "", False, "", "", "")),
    ("5 " * 20_000 + "mg", ("efficacy", "other", "5 mg", True, "5", "mg", "")),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(i, text, "clash") for i, (text, _) in enumerate(CLAIMS)]
    return classify.classify_claims(spark.createDataFrame(rows, "id long, claim_text string, comparator string").repartition(2))


def test_claims_get_their_columns(classified):
    assert classified.columns == ["id", "claim_text", *classify.COLUMNS]
    got = {r.id: tuple(r)[2:] for r in classified.collect()}
    assert got == {i: want for i, (_, want) in enumerate(CLAIMS)}


def test_classes_need_no_exchange(classified, spark):
    plan = classify.classify_claims(spark.createDataFrame([], "claim_text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert classified.where("false").count() == 0
