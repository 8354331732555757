"""Exact dedup by deterministic block naming (operator 2).

Texts, A-Z lower-cased, are cut into blocks of ``BLOCK`` characters.  The
distinct blocks are sorted and numbered; then each adjacent pair of a
document's names is named in the same way, until every document has one name.
Names are ranks among sorted distinct values, so two documents have equal
(rounds, name) exactly when their texts are equal; no hash decides it (128 bits
tell rows of one id apart).

Blocks are numbered within ranges of a hash of the block, so no task sees all
of them.  A block that many documents share is named from a dictionary of the
few most frequent ones (at most ``HOT_SHARE`` of them, a fixed number), which
is broadcast, and is never sent through the shuffle; pairs are named once per
distinct pair and joined back.

Defined results: null text counts as empty, and empty texts equal each other.
Rows that repeat both id and text are one document.  Null ids sort below all
others, so such a row stays only if all its equals have null ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlens.llm.common import HOT_SHARE, cut, identity, keyed, lower_ascii, spread_join

BLOCK = 4096
#: Ranges of the block hash, and bits of a name left for the rank in a range.
RANGES, RANK_BITS = 1 << 20, 43


def _range(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(RANGES))


def _name(rank: Column) -> Column:
    """Range number and rank within the range, as one long above 0."""
    return F.shiftleft("range", RANK_BITS) + rank


def _pieces(text: str, block: int) -> Column:
    """The blocks of a text; an empty text is one empty block."""
    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}+"), F.lit(0))
    return F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(whole)


def frequent_blocks(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, hot_name): the frequent blocks, lower-cased, numbered downward
    from -1 in sorted order, so that no name equals one made from a rank."""
    raw = keyed(df).select("text")
    total = raw.agg(F.sum(F.greatest(F.ceil(F.char_length("text") / block), F.lit(1)))).first()[0] or 0
    blocks = raw.select(F.explode(_pieces("text", block)).alias("raw")).select("raw", F.xxhash64("raw").alias("mark"))
    hot = blocks.groupBy("mark").count().where(F.col("count") > max(1.0, total / HOT_SHARE)).select("mark")
    blocks = blocks.join(F.broadcast(hot), "mark", "left_semi").select(lower_ascii(F.col("raw")).alias("block")).distinct()
    return cut(blocks.select("block", (-F.row_number().over(Window.orderBy("block"))).cast("long").alias("hot_name")))


def block_names(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, part, sha, blocks, pos, name): a row for each block; sha,
    of the whole lower-cased text, only in the row of the first."""
    docs = keyed(df).select("doc_id", "key", lower_ascii(F.col("text")).alias("low"))
    docs = docs.select("doc_id", "key", identity(F.col("doc_id"), F.col("low")).alias("part"), F.sha2("low", 256).alias("sha"), _pieces("low", block).alias("pieces"))
    rows = docs.select("doc_id", "key", "part", "sha", F.size("pieces").alias("blocks"), F.posexplode("pieces").alias("pos", "block"))
    rows = rows.join(F.broadcast(frequent_blocks(df, block)), "block", "left")
    is_hot = F.col("hot_name").isNotNull()
    rows = rows.select("doc_id", "key", "part", F.when(F.col("pos") == 0, F.col("sha")).alias("sha"), "blocks", "pos", "hot_name",
                       F.when(is_hot, -1 - _range("key")).otherwise(_range("block")).alias("range"),
                       F.when(~is_hot, F.col("block")).alias("block"))
    rank = F.dense_rank().over(Window.partitionBy("range").orderBy("block"))
    return rows.select("doc_id", "key", "part", "sha", "blocks", "pos", F.coalesce("hot_name", _name(rank)).alias("name"))


def identities(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, part, sha, rounds, name): a row for each document; equal
    (rounds, name) exactly when the lower-cased texts are equal."""
    level = block_names(df, block)
    # Rows that repeat id and text have the same blocks and so the same names.
    level = cut(level.groupBy("key", "part", "blocks", "pos").agg(
        F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha"), F.max("name").alias("name")))
    most = level.agg(F.max("blocks")).first()[0] or 1
    done = level.where("blocks = 1").select("doc_id", "key", "part", "sha", F.lit(0).alias("rounds"), "name")
    level = level.where("blocks > 1")
    for turn in range(1, math.ceil(math.log2(most)) + 1):
        odd = F.col("pos") % 2 == 1
        pairs = level.groupBy("key", "part", F.ceil(F.col("blocks") / 2).cast("int").alias("blocks"), F.shiftright("pos", 1).alias("pos")).agg(
            F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha"), F.max(F.when(~odd, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(0)).alias("b"))
        pairs = cut(pairs)
        rank = F.row_number().over(Window.partitionBy("range").orderBy("a", "b"))
        names = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("rows")).withColumn("range", _range("a", "b"))
        names = cut(names.select("a", "b", "rows", _name(rank).alias("name")))
        level = cut(spread_join(pairs, names, ["a", "b"], "rows", pairs.count()).drop("a", "b", "rows"))
        done = done.unionByName(level.where("blocks = 1").select("doc_id", "key", "part", "sha", F.lit(turn).alias("rounds"), "name"))
        level = level.where("blocks > 1")
    return done


def exact_groups(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, keep_id (largest id of its equals),
    group_size, kept, text_sha256 (of the lower-cased text), key, part."""
    named = cut(identities(df, block))
    groups = cut(named.groupBy("rounds", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    out = spread_join(named, groups, ["rounds", "name"], "group_size", named.count())
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.col("sha").alias("text_sha256"), "key", "part")
