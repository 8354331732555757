"""Merkle tree of a table, and the difference of two versions.

Rows are hashed; equal rows are counted together.  A bucket is a range of row
digests, namely those with one prefix of hex digits; its digest is that of its
sorted row digests and counts, and ``FAN`` buckets in a row make one of the next
level, up to the root.  Digests spread evenly, so no key makes a bucket large, and
the depth follows from the number of rows, so a bucket holds about ``BUCKET`` of them.
Unlike a sum of hashes, the root commits to the table: another table with the
same root would be a collision of sha256.

A version is a folder with the rows, in files sorted by digest and split by its first
two digits, and the tree's nodes.  ``diff`` compares two versions from the roots down
and follows only buckets that differ; rows are read for those alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .export import row_hash

BUCKET, FAN = 1024, 16
#: Rows (of a digest each) that are broadcast at most.
BROADCAST = 200_000
_DIGITS = int(math.log2(FAN)) // 4


def tree_depth(rows: int) -> int:
    """Levels below the root, so that a bucket has at most about BUCKET rows."""
    depth = 1
    while BUCKET * FAN ** depth < rows:
        depth += 1
    return depth


def hashed_rows(df: DataFrame, cols=None) -> DataFrame:
    cols = list(cols or df.columns)
    return df.select(*cols, row_hash([F.col(c) for c in cols]).alias("digest"))


def counted_rows(rows: DataFrame, cols) -> DataFrame:
    return rows.groupBy("digest").agg(*[F.first(c).alias(c) for c in cols], F.count(F.lit(1)).alias("copies"))


def digested(df: DataFrame, cols=None) -> DataFrame:
    """Distinct rows with ``digest`` and ``copies``."""
    cols = list(cols or df.columns)
    return counted_rows(hashed_rows(df, cols), cols)


def tree(rows: DataFrame, depth: int | None = None) -> DataFrame:
    """(level, prefix, digest, n_rows) of every bucket of rows (digest, copies);
    the root has level 0 and an empty prefix, the rows' buckets level ``depth``."""
    if depth is None:
        depth = tree_depth(rows.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"])

    def hashed(parts, text):
        return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*parts))), text), "|"), 256)

    level = rows.groupBy(F.substring("digest", 1, depth * _DIGITS).alias("prefix")).agg(
        hashed(("digest", "copies"), lambda r: F.concat(r["digest"], F.lit(":"), r["copies"].cast("string"))).alias("node"), F.sum("copies").alias("n_rows"))
    out = level = cut_lineage(level)
    for d in range(depth - 1, 0, -1):
        level = level.groupBy(F.substring("prefix", 1, d * _DIGITS).alias("prefix")).agg(
            hashed(("prefix", "node"), lambda r: F.concat(r["prefix"], F.lit("="), r["node"])).alias("node"), F.sum("n_rows").alias("n_rows"))
        level = cut_lineage(level)
        out = out.unionByName(level)
    root = level.agg(hashed(("prefix", "node"), lambda r: F.concat(r["prefix"], F.lit("="), r["node"])).alias("node"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    out = out.unionByName(root.select(F.lit("").alias("prefix"), "node", "n_rows"))
    return out.select((F.length("prefix") / _DIGITS).cast("int").alias("level"), "prefix", F.col("node").alias("digest"), "n_rows")


def write_version(df: DataFrame, path: str, cols=None) -> str:
    """Write the rows and the tree of ``df`` to a new folder; its root digest."""
    spark = df.sparkSession
    # Ranges of digests hold equal rows together, so these are counted after the one shuffle.
    hashed = hashed_rows(df, cols)
    rows = counted_rows(hashed.repartitionByRange("digest"), [c for c in hashed.columns if c != "digest"]).withColumn("shard", F.substring("digest", 1, 2))
    rows.sortWithinPartitions("shard", "digest").write.partitionBy("shard").parquet(f"{path}/rows")
    tree(spark.read.parquet(f"{path}/rows")).sortWithinPartitions("level", "prefix").write.parquet(f"{path}/nodes")
    return spark.read.parquet(f"{path}/nodes").where("level = 0").first()["digest"]


def differing_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """(prefix): the deepest buckets that two trees share the level of and that
    differ, found from the roots down."""
    depth = min(t.agg(F.max("level").alias("d")).first()["d"] for t in (old, new))
    found = None
    for level in range(depth + 1):
        sides = []
        for tree_, name in ((old, "old"), (new, "new")):
            nodes = tree_.where(F.col("level") == level).select("prefix", F.col("digest").alias(name))
            if found is not None:               # children of what differs
                parent = found.select(F.col("prefix").alias("_parent"))
                nodes = nodes.join(parent, F.substring("prefix", 1, (level - 1) * _DIGITS) == F.col("_parent"), "left_semi")
            sides.append(nodes)
        found = cut_lineage(sides[0].join(sides[1], "prefix", "full").where("not (old <=> new)").select("prefix"))
        if found.isEmpty():
            break
    return found


def diff(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Distinct rows whose number of copies differs between two version folders:
    their columns, digest, old_copies, new_copies (0 where absent)."""
    nodes = [spark.read.parquet(f"{p}/nodes") for p in (old, new)]
    found = differing_buckets(*nodes)
    length = found.select(F.coalesce(F.max(F.length("prefix")), F.lit(0)).alias("n")).first()["n"]
    found = _bounded(found)
    sides = []
    for path in (old, new):
        rows = spark.read.schema(_schema(spark, path)).parquet(f"{path}/rows")
        if length >= 2:                         # the shard is the folder: others are not read
            rows = rows.join(F.broadcast(found.select(F.substring("prefix", 1, 2).alias("shard")).distinct()), "shard", "left_semi")
        sides.append(rows.drop("shard"))
    # Digests are compared without the rows, which are read for those that differ.
    a, b = [r.withColumn("_bucket", F.substring("digest", 1, length)).join(found, F.col("_bucket") == F.col("prefix"), "left_semi") for r in sides]
    none = F.lit(0).cast("long")
    counts = a.select("digest", F.col("copies").alias("old_copies"), none.alias("new_copies")).unionByName(
        b.select("digest", none.alias("old_copies"), F.col("copies").alias("new_copies")))
    counts = counts.groupBy("digest").agg(F.sum("old_copies").alias("old_copies"), F.sum("new_copies").alias("new_copies"))
    differ = _bounded(cut_lineage(counts.where("old_copies <> new_copies")))
    cols = [c for c in sides[0].columns if c not in ("digest", "copies")]
    met = [rows.drop("copies").join(differ.where(which), "digest") for rows, which in zip(sides, ("old_copies > 0", "old_copies = 0"))]
    return met[0].unionByName(met[1]).select(*cols, "digest", "old_copies", "new_copies")


def _bounded(written: DataFrame) -> DataFrame:
    """Broadcast if it has at most ``BROADCAST`` rows."""
    return F.broadcast(written) if written.count() <= BROADCAST else written


def _schema(spark: SparkSession, path: str):
    """Schema of the rows with the shard as text: '01' is not a number."""
    schema = spark.read.parquet(f"{path}/rows").schema
    schema["shard"].dataType = schema["digest"].dataType
    return schema


def changed_keys(changes: DataFrame, key: str, cols) -> DataFrame:
    """``diff`` by key: change (added, removed, changed), key, and old and new
    value of each column.  A key of several differing rows has a row for each
    pair."""
    old = changes.where("old_copies > new_copies").select(F.col(key).alias("_old_key"), *[F.col(c).alias(f"old_{c}") for c in cols])
    new = changes.where("new_copies > old_copies").select(F.col(key).alias("_new_key"), *[F.col(c).alias(f"new_{c}") for c in cols])
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
    kind = F.when(F.col("_old_key").isNull(), "added").when(F.col("_new_key").isNull(), "removed").otherwise("changed")
    return both.select(kind.alias("change"), F.coalesce("_old_key", "_new_key").alias(key), *[f"old_{c}" for c in cols], *[f"new_{c}" for c in cols])
