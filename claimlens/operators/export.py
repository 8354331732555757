"""Bundle export.

The original hashes the bytes of three CSV files.  A distributed table has no
canonical byte order, so the fingerprint here is order- and layout-free: each
row is hashed (sha256 of its canonical text), and the row hashes are summed in
four 60-bit lanes as exact decimals.  Sums are mergeable, so the whole thing
is one partial aggregation — no sort, no collect, no single task — and equal
multisets of rows give equal fingerprints under any partitioning.  Sums of hashes
detect accidental change; they are a checksum, not a signature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import BUNDLE_NAME, BUNDLE_VERSION, PIPELINE_VERSION

LANES = 4


def row_hash(cols) -> Column:
    """sha256 of the row's canonical text: per field ``N`` for null, else ``V``,
    its length, ``:`` and its text, so no two rows share a text."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.lit("V"), F.char_length(text).cast("string"), F.lit(":"), text), F.lit("N"))
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


def table_fingerprint(df: DataFrame, cols=None, name: str = "table") -> DataFrame:
    """One row ``(table_name, n_rows, fingerprint)``."""
    cols = [F.col(c) for c in (cols or df.columns)]
    h = df.select(row_hash(cols).alias("_h"))
    lanes = [F.sum(F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"_l{i}")
             for i in range(LANES)]
    agg = h.agg(F.count(F.lit(1)).alias("n_rows"), *lanes)
    text = F.concat_ws(":", F.col("n_rows").cast("string"),
                       *[F.coalesce(F.col(f"_l{i}").cast("string"), F.lit("0")) for i in range(LANES)])
    return agg.select(F.lit(name).alias("table_name"), "n_rows", F.sha2(text, 256).alias("fingerprint"))


def bundle_manifest(tables: dict, created_at: str, bundle_name: str = BUNDLE_NAME) -> DataFrame:
    """E01 + E03: one-row manifest with row counts per table and the bundle
    fingerprint (sha256 over the table fingerprints in name order)."""
    parts = None
    for name, df in sorted(tables.items()):
        fp = table_fingerprint(df, name=name)
        parts = fp if parts is None else parts.unionByName(fp)
    rows = parts.agg(*[F.max(F.when(F.col("table_name") == n, F.col("n_rows"))).alias(f"rows_{n}")
                       for n in sorted(tables)],
                     F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(
                         F.struct("table_name", "fingerprint"))), lambda x: x["fingerprint"]), ":"), 256)
                     .alias("bundle_hash"))
    return rows.select(F.lit(bundle_name).alias("bundle_name"), F.lit(BUNDLE_VERSION).alias("version"),
                       F.lit(created_at).alias("created_at"), "bundle_hash", *[f"rows_{n}" for n in sorted(tables)],
                       F.lit(PIPELINE_VERSION).alias("pipeline_version"))
