"""Sinks (K01-K10).

Tables are written in their *file view* (arrays as ``json.dumps`` text,
booleans as ``true``/``false``, times as ISO-8601 ``...Z``) with fixed column
order and the explicit order column, so a reader can restore file order.
Outputs always go to a new path: Spark cannot overwrite a path it is reading
(the original rewrote the product file in place).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.normalize import CLAIM_COLUMNS, PRODUCT_COLUMNS
from ..operators.quality import file_view
from ..session import written

FRAME_COLUMNS = ("asin", "url", "cohort", "method", "category_hint", "stratum")
PAGE_INDEX_COLUMNS = ("asin", "page_sha256", "wayback_url", "captured_at", "status_code")
#: Rows of a file in order, about; and records, which hold many claims each.
FILE_ROWS, FILE_RECORDS = 100_000, 4_000
ASSET_COLUMNS = ("asin", "asset_id", "asset_type", "url", "wayback_url", "sha256", "storage_uri", "width",
                 "height")


def in_order(df: DataFrame, order_col: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """Rows in ranges of ``order_col``, sorted: part files concatenate in order.  Their
    number grows with the rows, since a reader may need a whole file in one task."""
    rows = written(df, "unordered")
    files = max(4, -(-rows.count() // file_rows))
    return rows.repartitionByRange(files, order_col).sortWithinPartitions(order_col)


def write_csv(df: DataFrame, path: str, columns, order_col: str | None = None, mode: str = "errorifexists"):
    """Header CSV with a fixed column order (extra columns dropped).  With an
    order column the rows are range-partitioned and sorted, so part files
    concatenate in order."""
    cols = ([order_col] if order_col else []) + [c for c in columns if c != order_col]
    out = file_view(df.select(*cols))
    if order_col:
        out = out.orderBy(order_col)
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_frame(df, path, order_col="frame_ord"):                      # K01
    write_csv(df, path, FRAME_COLUMNS, order_col)


def write_page_index(df, path, order_col="page_ord"):                  # K02
    write_csv(df, path, PAGE_INDEX_COLUMNS, order_col)


def write_assets(df, path, order_col=None):                            # K03
    write_csv(df, path, ASSET_COLUMNS, order_col)


def write_pages(df: DataFrame, path: str, partition_cols=()):          # K04
    """Page bodies as a parquet table (no small files per page)."""
    w = df.write.mode("errorifexists")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def write_raw_jsonl(df: DataFrame, path: str):                         # K05
    df.write.mode("errorifexists").json(path)


def write_products(df, path, order_col="row_ord"):                     # K06
    write_csv(df, path, PRODUCT_COLUMNS, order_col if order_col in df.columns else None)


def write_claims(df, path, order_col="claim_seq"):                     # K07
    write_csv(df, path, CLAIM_COLUMNS, order_col if order_col in df.columns else None)


def write_versioned(df: DataFrame, base: str, version: str, fmt: str = "parquet"):   # K08
    """Write an updated table to ``base/version=<v>`` instead of in place."""
    path = f"{base.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def write_report(df: DataFrame, path: str, order_cols=("report_pos",)):  # K09
    """Small ordered report -> one CSV file (bounded by the rule count)."""
    df.orderBy(*order_cols).coalesce(1).write.mode("errorifexists").option("header", True).csv(path)


def write_bundle(tables: dict, manifest: DataFrame, directory: str):   # K10
    """Tables under ``<dir>/<name>/`` plus a one-row JSON manifest."""
    d = directory.rstrip("/")
    for name, (df, columns, order_col) in tables.items():
        write_csv(df, f"{d}/{name}", columns, order_col)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{d}/bundle_metadata")
    return d


__all__ = ["in_order", "write_csv", "write_frame", "write_page_index", "write_assets", "write_pages", "write_raw_jsonl",
           "write_products", "write_claims", "write_versioned", "write_report", "write_bundle"]
