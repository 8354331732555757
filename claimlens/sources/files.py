"""File and table sources.

Explicit schemas everywhere (no inference).  CSV/JSONL row order is not kept
by Spark, so every pipeline file carries an explicit ``*_ord`` column (the
sinks write it); order-sensitive operators use that column.  For files of
other origin it is derived from the rows' places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..schemas import ASSETS_DDL, FRAME_DDL, PAGES_INDEX_DDL, RAW_DDL
from ..session import cut_lineage


def read_table(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """Parquet table (the default storage; filters and projections reach the
    scan).  ``ddl`` pins the schema when given."""
    r = spark.read
    if ddl:
        r = r.schema(ddl)
    return r.parquet(path)


def in_file_order(rows: DataFrame, name: str) -> DataFrame:
    """Add ``name``: a row's 0-based place over all files, by path and then by
    place in the file.  ``rows`` must come straight from a file scan.

    Rows are numbered inside their split; the splits' counts (one row a split)
    are summed up over the files.  The numbered rows are written to the
    checkpoint folder first, since another run may cut the files elsewhere."""
    at = F.col("_metadata")
    rows = cut_lineage(rows.select("*", at["file_path"].alias("_file"), at["file_block_start"].alias("_block"),
                                   F.monotonically_increasing_id().alias("_row")))
    splits = rows.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    rows = rows.join(splits, ["_file", "_block"])
    return rows.withColumn(name, F.col("_row") + F.col("_shift")).drop("_file", "_block", "_row", "_shift")


def read_csv(spark: SparkSession, path: str, ddl: str, multiline: bool = True) -> DataFrame:
    """Header CSV with quoted cells; empty cells read as null (Q01).

    Columns are found by the header's names; one that the file lacks is null,
    except an order column (the first of ``ddl`` if named ``*_ord``), which
    then is the row's place in the files.  A cell that does not fit its type
    fails the job.  With ``multiline`` (cells may hold line ends) a file is
    one task; without it, large files are split."""
    cells = (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
                  .option("mode", "FAILFAST").csv(path))
    wanted = T._parse_datatype_string(ddl).fields
    order = wanted[0].name if wanted[0].name.endswith("_ord") else None
    if order and order not in cells.columns:
        cells = in_file_order(cells, order)
    return cells.select(*[(F.col(f.name) if f.name in cells.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in wanted])


def read_frame_csv(spark, path, multiline: bool = True):
    return read_csv(spark, path, FRAME_DDL, multiline)


def read_page_index_csv(spark, path, multiline: bool = True):
    return read_csv(spark, path, PAGES_INDEX_DDL, multiline)


def read_assets_csv(spark, path, multiline: bool = True):
    return read_csv(spark, path, ASSETS_DDL, multiline)


def read_raw_jsonl(spark: SparkSession, path: str, ddl: str = RAW_DDL, has_order: bool = True) -> DataFrame:
    """JSON lines with nested claims; a malformed line fails the job
    (as the original does).  ``has_order=False`` is for files whose records
    carry no ``rec_ord``: it then is the record's place in the files."""
    rows = spark.read.schema(ddl).option("mode", "FAILFAST").json(path)
    return rows if has_order else in_file_order(rows.drop("rec_ord"), "rec_ord")


def read_page_bodies(spark: SparkSession, directory: str, suffix: str = ".html") -> DataFrame:
    """One document per file, key = file name without the suffix.  Pages
    without a body file simply do not appear (an inner join then skips them)."""
    df = spark.read.text(directory, wholetext=True)
    files = df.select(F.col("_metadata.file_name").alias("_f"), F.col("value").alias("html"))
    return files.where(F.col("_f").endswith(suffix)).select(
        F.expr(f"substring(_f, 1, length(_f) - {len(suffix)})").alias("asin"), "html")


# S09-S12 are re-aimed as input tables (no network clients): search results,
# model responses, OCR word rows and capture logs are read like any table.
SEARCH_RESULTS_DDL = "stratum STRING, stratum_ord INT, keyword STRING, keyword_ord INT, rank BIGINT, link STRING"
RESPONSES_DDL = "asin STRING, asset_id STRING, source STRING, body STRING"
OCR_WORDS_DDL = ("asset_id STRING, idx INT, text STRING, conf STRING, left INT, top INT, width INT, "
                 "height INT")
CAPTURES_DDL = "page_ord BIGINT, asin STRING, url STRING, status_code INT, html STRING, captured_at TIMESTAMP"
