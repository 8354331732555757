"""Policy-hint columns.

Each rule becomes substring tests on the folded text, and a literal regex where
its pattern has syntax (tried only on texts with what the pattern requires), so
the matcher is a plain projection: no text x pattern join (which would plan as a
nested-loop join) and no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import HintRules, L_HARD_MIN
from .text import ascii_fold, empty_string_array, pattern_predicate


def _ids(text: Column, rules, folded: Column | None = None) -> Column:
    """Ids of the rules of which a pattern is found; ``folded`` is the text's
    ``ascii_fold``, where the caller has it as a column."""
    if not rules:
        return empty_string_array()
    folded = ascii_fold(text) if folded is None else folded
    return F.array_compact(F.array(*[F.when(pattern_predicate(text, patterns, folded), F.lit(hint_id)) for hint_id, patterns in rules]))


def phi_hint_ids(text: Column, rules: HintRules = HintRules(), folded: Column | None = None) -> Column:
    """Ids of physics-gate hints whose patterns match, in rule order."""
    return _ids(text, rules.phi, folded)


def _k_text(text: Column, ingredients: Column | None) -> Column:
    ingredients = empty_string_array() if ingredients is None else F.coalesce(ingredients, empty_string_array())
    return F.concat(text, F.lit(" "), F.array_join(ingredients, " "))


def k_hint_ids(text: Column, ingredients: Column | None = None, rules: HintRules = HintRules()) -> Column:
    """Safety-gate hint ids over ``text + ' ' + ' '.join(ingredients)``."""
    return _ids(_k_text(text, ingredients), rules.k)


def _token_hits(text: Column, rules: HintRules, low: Column | None = None):
    low = F.lower(text) if low is None else low
    return [(tok, w, F.coalesce(low.contains(tok.lower()), F.lit(False))) for tok, w in rules.l_weights]


def l_tokens(text: Column, rules: HintRules = HintRules(), low: Column | None = None) -> Column:
    """Exaggeration tokens (lower-case substring), rule order, original case."""
    hits = _token_hits(text, rules, low)
    if not hits:
        return empty_string_array()
    return F.array_compact(F.array(*[F.when(hit, F.lit(tok)) for tok, _, hit in hits]))


def l_score(text: Column, rules: HintRules = HintRules(), low: Column | None = None) -> Column:
    """Sum of the weights of the tokens present (each counted once)."""
    hits = _token_hits(text, rules, low)
    total = F.lit(0)
    for _, w, hit in hits:
        total = total + F.when(hit, F.lit(w)).otherwise(F.lit(0))
    return total.cast("int")


def gate_hint(phi_ids: Column, k_ids: Column, score: Column) -> Column:
    """K beats phi beats hard L beats soft L."""
    return (F.when(F.size(k_ids) > 0, "k_candidate")
            .when(F.size(phi_ids) > 0, "phi_candidate")
            .when(score >= L_HARD_MIN, "l_hard")
            .when(score > 0, "l_soft")
            .otherwise("none"))


def with_hints(df, text_col: str = "claim_text", ingredients_col: str | None = None,
               rules: HintRules = HintRules()):
    """Adds phi_hint_ids, k_hint_ids, l_tokens, l_token_score, gate_hint."""
    text, low = F.col(text_col), F.col("_low")
    ingredients = F.col(ingredients_col) if ingredients_col else None
    # Lower-cased and folded once a row, as columns that all rules refer to.
    df = df.withColumn("_low", F.lower(text)).withColumn("_k_text", _k_text(text, ingredients))
    df = df.withColumn("_folded", ascii_fold(text, low)).withColumn("_k_folded", ascii_fold(F.col("_k_text")))
    return (df.withColumn("phi_hint_ids", phi_hint_ids(text, rules, F.col("_folded")))
              .withColumn("k_hint_ids", _ids(F.col("_k_text"), rules.k, F.col("_k_folded")))
              .withColumn("l_tokens", l_tokens(text, rules, low))
              .withColumn("l_token_score", l_score(text, rules, low))
              .withColumn("gate_hint", gate_hint(F.col("phi_hint_ids"), F.col("k_hint_ids"),
                                                 F.col("l_token_score")))
              .drop("_low", "_k_text", "_folded", "_k_folded"))


def ingredients_norm(text: Column, rules: HintRules = HintRules()) -> Column:
    """D02 (extension): canonical ingredient names whose alias (or the name
    itself) occurs as a whole phrase, in alias-table order."""
    if not rules.ingredient_aliases:
        return empty_string_array()
    return F.array_compact(F.array(*[
        F.when(text.rlike(r"(?iU)\b(?:" + "|".join([canon, *aliases]) + r")\b"), F.lit(canon))
        for canon, aliases in rules.ingredient_aliases]))


def warning_match(ingredients: Column, rules: HintRules = HintRules()) -> Column:
    """D03 (extension): any normalised ingredient on the warning list."""
    if not rules.fda_warnings:
        return F.lit(False)
    return F.arrays_overlap(ingredients, F.array(*[F.lit(w) for w in rules.fda_warnings]))
