"""Document fingerprints by closed syncmers (operator 1), DataFrame functions only.

A text is cut into units: runs of up to 16 characters other than white space,
characters from U+2E80 on (scripts without spaces) one by one.  A k-mer of
``K`` units is *closed* when the smallest of the hashes of its inner ``S``-mers
is the first or the last one.  Whether it is chosen depends on its own units
alone, so an edit elsewhere never moves the anchors around it.  The fingerprint
is the 32-bit hashes of the chosen k-mers in text order.

Defined results: null text counts as empty; a text without units has an empty
fingerprint; where no ``K``-mer is closed (fewer than ``K`` units, and some texts
of up to 8) the anchors are all its ``S``-mers, and a single unit is its own anchor.  Two empty fingerprints are alike (1.0), an
empty and another are not (0.0).  Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlens.llm.common import keyed, let
from claimlens.operators.ranges import quantile_bounds, range_bucket

K, S = 6, 2
UNIT = r"[^\s\x{2E80}-\x{3FFFF}]{1,16}|[\x{2E80}-\x{3FFFF}&&\S]"
#: Rows of one ordered bucket; its texts are sorted by one task.
ROWS_PER_BUCKET = 4096


def anchors(text: Column) -> Column:
    """array<int>: hashes of the closed syncmers of ``text``, in text order."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))
    return let(F.transform(units, lambda u: F.xxhash64(u)), _chosen)


def _chosen(unit: Column) -> Column:
    few = F.when(F.size(unit) == 1, F.transform(unit, lambda u: F.hash(u))).otherwise(
        F.transform(F.slice(unit, 1, F.greatest(F.size(unit) - S + 1, F.lit(0))), lambda u, i: F.hash(u, F.get(unit, i + 1))))
    inner = F.transform(unit, lambda u, i: F.xxhash64(u, F.get(unit, i + 1)))
    return let(let(inner, _closed), lambda closed: F.when(F.size(closed) == 0, few).otherwise(closed))


def _closed(inner: Column) -> Column:
    """inner: hash of the S-mer at each unit; the last one is not whole, and a
    k-mer that would need it or more has a null as its last S-mer."""
    last = K - S

    def anchor(first: Column, i: Column) -> Column:
        end = F.get(inner, i + last)
        between = F.least(*[F.get(inner, i + j) for j in range(1, last)])
        whole = i < F.size(inner) - K + 1
        return F.when(whole & (F.least(first, end) <= between), F.hash(first, F.get(inner, i + S), end))

    return F.array_compact(F.transform(inner, anchor))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two fingerprints' distinct anchors, 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * both / total)


def as_text(fingerprint: Column) -> Column:
    """Anchors as 8 hex digits each, joined."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))), 8, "0")), "")


def with_next(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(doc_id, text, marks, next_text, next_marks): each document, its anchors
    and those of the next one by id (then text; null ids last; after the last
    comes the first).

    Ids are cut into ranges at their quantiles.  The first document of a range
    also goes, as a guard, to the range before it (that of the first range to
    the last), so one shuffle and a window by range give every neighbour.
    """
    docs = keyed(df).select("doc_id", "text", "key")
    bounds = quantile_bounds(docs, F.col("key"), rows_per_bucket)
    last = max(0, len(bounds) - 1)
    bucket = range_bucket(F.col("key"), bounds).cast("int")
    heads = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array(F.lit(None).cast("long"))
    docs = docs.withColumn("marks", anchors(F.col("text"))).withColumn("bucket", bucket)
    is_head = F.get(heads, F.col("bucket")) == F.col("key")
    before = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    places = F.array_compact(F.array(F.struct(F.lit(False).alias("guard"), F.col("bucket").alias("bucket")),
                                     F.when(is_head, F.struct(F.lit(True).alias("guard"), before.alias("bucket")))))
    dealt = docs.select("doc_id", "key", "text", "marks", F.explode(places).alias("at")) \
                .select("doc_id", "key", "text", "marks", "at.guard", "at.bucket")
    order = Window.partitionBy("bucket").orderBy("guard", "key", F.col("doc_id").isNull(), "text")
    return dealt.select("doc_id", "text", "marks", "guard", F.lead("text").over(order).alias("next_text"),
                        F.lead("marks").over(order).alias("next_marks")).where(~F.col("guard")).drop("guard")


def fingerprints(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Fingerprint of every text and of its edited text: the last
    floor(n_chars / 2) characters replaced by the first as many (or all) of the
    next document's text."""
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half))
    made = with_next(df, rows_per_bucket).select("doc_id", n.alias("n_chars"), "marks", "next_marks", edited.alias("edited"))
    made = made.withColumn("edited_marks", anchors(F.col("edited")))
    return made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("marks")).alias("fingerprint"), as_text(F.col("edited_marks")).alias("edited_fingerprint"),
                       likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
                       likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))
