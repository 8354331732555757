"""Claim classification by rules (D10): type, implied outcome, and the number a
claim states with its unit and comparator.

A claim is read as a row of tokens (numbers, ``%``, words), and positions decide:

- every number may take the nearest unit at most ``REACH`` tokens away, the one
  after it before the one in front of it at equal distance;
- the claim's quantifier is the number whose unit is nearest, the first such; a
  claim whose numbers have no unit keeps its first number without one;
- the comparator is the phrase of a comparison word (``vs``, ``than``,
  ``compared to`` / ``with``) and the token behind it, of the comparison nearest to
  the quantifier, or the first one if there is none.

Type and outcome are those of the first rule, in order, that has a word in the
claim.  All of it is array functions inside the row: no exchange, no Python.

Defined results: a null text counts as empty; texts without tokens get the
defaults (``efficacy``, ``other``, empty strings).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Tokens: numbers with inner points or commas, percent signs, words.
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|%|[\p{L}]+"
REACH = 3
# Words of the claim types and outcomes; the first rule that fits counts.
TYPE_RULES = (
    ("safety", ("safe", "safety", "gentle", "nontoxic", "harmless", "tolerated")),
    ("medical", ("cure", "cures", "treat", "treats", "diagnose", "prevent", "prevents", "disease", "fda", "doctor")),
    ("mechanism", ("technology", "energy", "quantum", "quantumly", "frequency", "ions", "emits", "formula")),
    ("efficacy", ("proven", "effective", "improves", "reduces", "supports", "relief", "boosts")),
)
OUTCOME_RULES = (
    ("sleep_quality", ("sleep", "insomnia")),
    ("hair_growth", ("hair", "scalp")),
    ("weight_loss", ("weight", "fat", "slim")),
    ("pain_relief", ("pain", "ache", "relief")),
    ("anti_aging", ("aging", "ageing", "wrinkle", "wrinkles")),
    ("detox", ("detox", "toxins", "cleanse")),
    ("cardiovascular", ("heart", "blood", "cholesterol", "circulation")),
    ("cognitive", ("memory", "focus", "brain", "cognitive")),
)
UNITS = ("%", "percent", "mg", "mcg", "g", "kg", "ml", "iu", "x", "cx", "times", "hours", "hour", "days", "day", "weeks", "week", "months", "month", "years", "year")
COMPARISONS = ("vs", "versus", "than")
#: Comparisons of two tokens: the first, and what may follow it.
COMPARED, COMPARED_BY = "compared", ("to", "with")
COLUMNS = ("claim_type", "implied_outcome", "quantifier", "has_numeric_quantifier", "quant_value", "quant_unit", "comparator")


def _token(tokens: Column, at: Column) -> Column:
    return F.coalesce(F.get(tokens, at), F.lit(""))


def _first_rule(tokens: Column, rules, default: str) -> Column:
    return F.coalesce(*[F.when(F.arrays_overlap(tokens, F.lit(list(words))), F.lit(name)) for name, words in rules], F.lit(default))


def _positions(tokens: Column, test) -> Column:
    """Positions of the tokens that pass ``test(token, position)``, ascending."""
    at = F.transform(tokens, lambda x, i: F.when(test(x, i), i))
    return F.array_compact(at)


def _quantifier(tokens: Column, numbers: Column) -> Column:
    """(rank, number, unit): positions of the best number and its unit, which is
    -1 where none is in reach; null without numbers.  Only the places in reach
    are looked at, the nearest first, so a long text costs its numbers."""
    reach = [place for d in range(1, REACH + 1) for place in (d, -d)]
    listed = F.lit(list(UNITS))

    def own(n: Column) -> Column:
        near = F.transform(F.lit(reach), lambda place, rank: F.when(
            F.array_contains(listed, _token(tokens, n + place)), F.struct(rank.alias("rank"), n.alias("number"), (n + place).alias("unit"))))
        none = F.struct(F.lit(len(reach)).alias("rank"), n.alias("number"), F.lit(-1).alias("unit"))
        return F.coalesce(F.array_min(near), none)
    return F.array_min(F.transform(numbers, own))


def classify_claims(claims: DataFrame, text_col: str = "claim_text") -> DataFrame:
    """``claims`` with ``COLUMNS``, which replace columns of those names.

    ``quantifier`` is number and unit as one text (``87%``, ``14 days``)."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TOKEN), F.lit(0))
    out = claims.drop(*COLUMNS).withColumn("_t", tokens)
    t = F.col("_t")
    out = out.withColumn("_q", _quantifier(t, _positions(t, lambda x, i: x.rlike("^[0-9]"))))
    two = lambda x, i: (x == COMPARED) & _token(t, i + 1).isin(*COMPARED_BY)
    out = out.withColumn("_compared", _positions(t, lambda x, i: x.isin(*COMPARISONS) | two(x, i)))
    q = F.col("_q")
    best = F.array_min(F.transform("_compared", lambda c: F.struct(F.coalesce(F.abs(c - q["number"]), c).alias("distance"), c.alias("at"))))
    out = out.withColumn("_c", best["at"])
    value = F.when(q.isNotNull(), _token(t, q["number"])).otherwise("")
    unit = F.when(q["unit"] >= 0, _token(t, q["unit"])).otherwise("")
    word = _token(t, F.col("_c"))
    compared = F.when(word == COMPARED, F.concat_ws(" ", word, _token(t, F.col("_c") + 1), _token(t, F.col("_c") + 2))) \
                .otherwise(F.concat_ws(" ", word, _token(t, F.col("_c") + 1)))
    made = {"claim_type": _first_rule(t, TYPE_RULES, "efficacy"), "implied_outcome": _first_rule(t, OUTCOME_RULES, "other"),
            "quantifier": F.when(unit == "", value).when(unit == "%", F.concat(value, unit)).otherwise(F.concat_ws(" ", value, unit)),
            "has_numeric_quantifier": q.isNotNull(), "quant_value": value, "quant_unit": unit,
            "comparator": F.when(F.col("_c").isNull(), "").otherwise(F.trim(compared))}
    return out.withColumns(made).drop("_t", "_q", "_compared", "_c")
