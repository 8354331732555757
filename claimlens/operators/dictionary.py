"""Dictionary join: phrases of a list table found in texts.

A text's tokens give its n-grams of up to ``longest`` tokens, and an equi-join on
the phrase meets them with the list; Spark broadcasts a small list and shuffles for a
large one, so the cost per text does not depend on the list's length.  Only n-grams
that begin with some entry's first token are made: the first join is on single
tokens, where the lengths of entries beginning so are known.  Of overlapping
matches the leftmost wins, then the longest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TOKEN = r"[\p{L}\p{N}]+"


def phrase_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def prepared_list(entries: DataFrame, phrase_col: str, name_col: str) -> DataFrame:
    """(phrase, first, size, name): each distinct phrase once, its tokens joined by
    a space; of several names of a phrase the smallest.  Phrases without tokens
    and null names are left out."""
    tokens = phrase_tokens(F.col(phrase_col))
    rows = entries.select(tokens.alias("tokens"), F.col(name_col).cast("string").alias("name")).where("size(tokens) > 0 and name is not null")
    rows = rows.groupBy(F.array_join("tokens", " ").alias("phrase")).agg(F.min("name").alias("name"), F.min("tokens").alias("tokens"))
    return rows.select("phrase", F.col("tokens")[0].alias("first"), F.size("tokens").alias("size"), "name")


def matches(df: DataFrame, id_col: str, text_col: str, entries: DataFrame, phrase_col: str = "phrase", name_col: str = "name") -> DataFrame:
    """(id, start, size, phrase, name) of each chosen match; start counts tokens
    from 0.  Ids are kept as they are; rows that repeat an id are told apart by
    their text, equal rows are matched once."""
    listed = prepared_list(entries, phrase_col, name_col)
    begins = listed.groupBy("first").agg(F.array_sort(F.collect_set("size")).alias("sizes"))
    texts = df.select(F.col(id_col).alias("id"), phrase_tokens(F.col(text_col)).alias("tokens")).select("id", F.xxhash64("tokens").alias("text"), "tokens")
    # The text is hashed below the explode: beside it, it would be hashed once a token.
    # The outer form: a plain explode makes the optimizer take texts apart twice.
    at = texts.select("id", "text", "tokens", F.posexplode_outer("tokens").alias("start", "first")).where("first is not null")
    # A window of the tokens goes on, as long as the longest entry with this start.
    longest = listed.agg(F.coalesce(F.max("size"), F.lit(0)).alias("n")).first()["n"]
    at = at.select("id", "text", "start", "first", F.slice("tokens", F.col("start") + 1, F.lit(max(1, longest))).alias("window"))
    met = at.join(begins, "first").select("id", "text", "start", "window", F.explode("sizes").alias("size")).where("size <= size(window)")
    grams = met.select("id", "text", "start", "size", F.array_join(F.slice("window", 1, F.col("size")), " ").alias("phrase"))
    found = grams.join(listed.select("phrase", "name"), "phrase")
    best = found.groupBy("id", "text", "start").agg(F.max(F.struct("size", "phrase", "name")).alias("m"))
    # One text's matches in order; a match is chosen where the last chosen one has ended.
    row = F.struct("start", F.col("m.size").alias("size"), F.col("m.phrase").alias("phrase"), F.col("m.name").alias("name"))
    rows = best.groupBy("id", "text").agg(F.array_sort(F.collect_list(row)).alias("all"))
    kept = F.aggregate(
        "all", F.struct(F.lit(0).alias("free"), F.filter("all", lambda m: F.lit(False)).alias("kept")),
        lambda s, m: F.when(m["start"] >= s["free"], F.struct((m["start"] + m["size"]).alias("free"), F.concat(s["kept"], F.array(m)).alias("kept"))).otherwise(s))
    return rows.select("id", F.explode(kept["kept"]).alias("m")).select(F.col("id").alias(id_col), "m.*")


def rule_lists(spark, rules) -> tuple[DataFrame, DataFrame]:
    """The policy's alias table (phrase, name) and warning list (name)."""
    rows = [(phrase, name) for name, aliases in rules.ingredient_aliases for phrase in (name, *aliases)]
    return spark.createDataFrame(rows, "phrase string, name string"), spark.createDataFrame([(w,) for w in rules.fda_warnings], "name string")


def names_per_row(df: DataFrame, id_col: str, text_col: str, entries: DataFrame, **kw) -> DataFrame:
    """(id, names): sorted distinct names found, for ids with any."""
    return matches(df, id_col, text_col, entries, **kw).groupBy(id_col).agg(F.array_sort(F.collect_set("name")).alias("names"))


def warned(found: DataFrame, warnings: DataFrame, id_col: str, name_col: str = "name") -> DataFrame:
    """(id) whose names (id, names) hold one of the ``warnings``' names."""
    names = found.select(id_col, F.explode("names").alias("name"))
    return names.join(warnings.select(F.col(name_col).cast("string").alias("name")).distinct(), "name", "left_semi").select(id_col).distinct()
