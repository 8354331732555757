"""A training corpus from raw documents, in five stages.

Each stage gets all that the one before kept, decides by one operator of
``claimlens.llm`` and returns the columns of ``documents``; the last returns
token counts and digests.  Stages are written as Parquet and read again, so
each one's work survives lost executors.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimlens.llm import block_names, bpe, minhash, mixing, quality
from claimlens.llm.common import LAST, identity, shared_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: None: a trained classifier, near-duplicate groups and BPE have no SQL.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of 0.5 or more)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _columns(quality.with_scores(_columns(docs), labels).where("score >= 0.5"))


def _only(docs: DataFrame, decided: DataFrame, key: str, text: Column) -> DataFrame:
    """Rows of ``docs`` whose (key, part) is in ``decided``; parts are those of
    ``text`` as the stage's operator reads it."""
    own = _columns(docs).withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("_part", identity(F.col("doc_id").cast("long"), text))
    decided = decided.select(F.col("key").alias("_key"), F.col("part").alias("_part"), *([key] if key else []))
    return own.join(decided, ["_key", "_part"])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the one with the largest id."""
    kept = block_names.exact_groups(_columns(docs)).where("kept")
    low = block_names.lower_ascii(F.coalesce("text", F.lit("")))
    return _columns(_only(docs, kept, "", low).dropDuplicates(["_key", "_part"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (similarity 0.8 or more) the smallest id."""
    kept = minhash.near_groups(_columns(docs)).where("kept")
    return _columns(_only(docs, kept, "", F.coalesce("text", F.lit(""))).dropDuplicates(["_key", "_part"]))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    taken = mixing.mixed(_columns(docs)).where("repeats > 0")
    rows = _only(docs, taken, "repeats", F.coalesce("text", F.lit(""))).dropDuplicates(["_key", "_part"])
    return _columns(rows.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("repeats")))))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mix", mix), ("bpe", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the
    cluster's shared folder and read from there."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_path(spark, "corpus")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
