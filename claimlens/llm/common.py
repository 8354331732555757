"""What the operators of this subpackage share.

A *document* is a row's (id, text); rows that repeat both are one document.
``keyed`` gives each one a key that is a function of its content, so a task that
runs again after a lost executor produces the same key.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimlens.session import ensure_checkpoint_dir

#: Stands for a null id in orderings: nulls come last.
LAST = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, key, part): text with null as empty, key = id with null
    last, part = digest of the text, which tells rows of the same id apart (and a
    null id from the largest one, see ``identity``).
    All other columns are left out, so their names cannot clash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.col(id_col).cast("long")
    return df.select(doc.alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("key"), identity(F.col("doc_id"), F.col("text")).alias("part"))


def _hex(text: Column) -> tuple[Column, Column]:
    return tuple(F.lpad(F.hex(F.xxhash64(F.lit(seed), text)), 16, "0") for seed in (1, 2))


def digest(text: Column) -> Column:
    """128 bits of a text, as binary: two 64-bit hashes of different seeds."""
    return F.unhex(F.concat(*_hex(text)))


def identity(doc_id: Column, text: Column) -> Column:
    """``digest`` of a text; a null id and the id ``LAST``, which have one key,
    have other last digits: F and 0."""
    first, second = _hex(text)
    last = F.when(doc_id.isNull(), "F").when(doc_id == LAST, "0").otherwise(F.substring(second, 16, 1))
    return F.unhex(F.concat(first, F.substring(second, 1, 15), last))


def no_id() -> Column:
    """Whether a row of (key, part) has a null id."""
    return (F.col("key") == LAST) & F.hex("part").endswith("F")


#: A table with rows of fewer documents than this a task has fewer tasks.
PER_TASK = 2048


def tasks_for(documents: int) -> int:
    """Tasks that a table derived from so many documents is worth at most."""
    return max(1, -(-documents // PER_TASK))


def cut(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there; in
    ``parts`` parts at most.  Every part costs files, there and in each shuffle that
    reads it, of a disk block at least."""
    ensure_checkpoint_dir(df.sparkSession)
    return few(df, parts).checkpoint(eager=True)


def few(df: DataFrame, parts: int | None) -> DataFrame:
    return df.coalesce(parts) if parts else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, beside the checkpoints."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Text bytes of a batch that goes to a Python worker.  The JVM holds a batch outside
#: its heap, twice while it grows, and the worker holds it again.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of the session's Arrow batches; a smaller setting stays."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", spark.conf.get(ARROW_BYTES).strip().lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` computed once: a lambda's argument is bound,
    while an alias that a lambda refers to may be inlined and run per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, all else unchanged."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


#: A key is hot when it has more than 1 / HOT_SHARE of all rows, so fewer than
#: HOT_SHARE keys are: a proven bound for what is broadcast.
HOT_SHARE = 4096


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row per key and the
    number of left rows with that key in column ``rows``.  Hot keys' rows stay
    where they are and meet a broadcast; the others meet in a shuffle."""
    hot = right.where(F.col(rows) > total / HOT_SHARE)
    cold = right.where(F.col(rows) <= total / HOT_SHARE)
    there = left.join(F.broadcast(hot), keys)
    return there.unionByName(left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys))


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
