"""Captured pages: hashing, filters, gates, page index, assets ids (G01-G15,
D07, D11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import ARCHIVE_HOST, IMAGE_HOST_NEEDLE, MAX_ASSETS_PER_PAGE

HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


def content_hash(c: Column) -> Column:
    """sha256 hex of the UTF-8 text (same digest as Python/DuckDB)."""
    return F.sha2(c, 256)


def successful(captures: DataFrame) -> DataFrame:
    """Status 200 and a non-empty body."""
    return captures.where((F.col("status_code") == 200) & (F.length(F.col("html")) > 0))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST_RE, 1))


def allowed_by_rules(captures: DataFrame, rules: DataFrame) -> DataFrame:
    """Keep captures whose host has an ``allowed`` rule; a host
    without a rule (or with an unknown decision) is denied.  A left-semi join:
    the rules table is one row per host, so AQE broadcasts it when it is small
    and falls back to a shuffle join otherwise."""
    allow = rules.where(F.coalesce(F.col("allowed"), F.lit(False))).select(F.col("host").alias("_host")).distinct()
    c = captures.withColumn("_host", url_host(F.col("url")))
    return c.join(allow, "_host", "left_semi").drop("_host")


def py_isoformat_z(ts: Column) -> Column:
    """``datetime.isoformat() + 'Z'`` — the fraction is omitted when the
    micro-seconds are 0."""
    t = ts.cast("timestamp")
    frac = F.unix_micros(t) % 1000000
    return F.when(t.isNull(), F.lit(None).cast("string")).when(
        frac == 0, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).otherwise(
        F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))


def page_index(captures: DataFrame, archive_url: Column | None = None) -> DataFrame:
    """G01 + G02 + G04: hash the body of successful captures and project the
    page index ``(page_ord, asin, page_sha256, wayback_url, captured_at,
    status_code)``."""
    ok = successful(captures)
    return ok.select("page_ord", "asin", content_hash(F.col("html")).alias("page_sha256"),
                     (archive_url if archive_url is not None else F.lit("")).alias("wayback_url"),
                     "captured_at", "status_code")


def archive_url(status: Column, location: Column, url: Column, enabled: bool = True) -> Column:
    """Archive answer -> archive URL.  200 with a relative location ->
    absolute; 200 without a location -> ``web/*/url``; other status -> null."""
    if not enabled:
        return F.lit(None).cast("string")
    return (F.when(status != 200, F.lit(None).cast("string"))
             .when(location.isNull() | (location == ""), F.concat(F.lit(ARCHIVE_HOST + "/web/*/"), url))
             .when(location.startswith("/"), F.concat(F.lit(ARCHIVE_HOST), location))
             .otherwise(location))


def page_integrity(index: DataFrame, bodies: DataFrame, key: str = "page_ord") -> DataFrame:
    """D11 (extension): re-hash every stored body and compare with the index."""
    b = bodies.select(key, content_hash(F.col("html")).alias("body_sha256"))
    return index.join(b, key, "left").select(
        key, "asin", "page_sha256", "body_sha256",
        F.coalesce(F.col("page_sha256") == F.col("body_sha256"), F.lit(False)).alias("intact"))


def select_assets(candidates: DataFrame, key: str = "asin", needle: str = IMAGE_HOST_NEEDLE,
                  cap: int = MAX_ASSETS_PER_PAGE) -> DataFrame:
    """G08-G12 over parser candidates ``(key, tier, pos, url, raw_src, alt)``.

    tier 1 = selector hits (resolved URL): keep URLs containing the needle,
    first occurrence per URL.  tier 2 = the first <img> elements (fallback):
    first occurrence per raw ``src``, used only when a page kept no tier-1 URL.
    Then at most ``cap`` per page, id ``{key}_img{j:02d}`` and the URL hash."""
    first = F.col("tier") == 1
    good = F.when(first, F.col("url").contains(needle)).when(F.col("tier") == 2, F.coalesce(F.col("raw_src"), F.lit("")) != "")
    kept = candidates.where(good).withColumn("_same", F.when(first, F.col("url")).otherwise(F.col("raw_src")))
    kept = kept.groupBy(key, "tier", "_same").agg(F.min("pos").alias("pos"), F.min_by("url", "pos").alias("url"), F.min_by("alt", "pos").alias("alt"))
    # One pass over the candidates (they come from parsed pages): tier 1 ranks
    # before tier 2, so a page with a tier-1 row never shows its tier-2 rows.
    best = F.min("tier").over(Window.partitionBy(key))
    kept = kept.withColumn("_best", best).where(F.col("tier") == F.col("_best"))
    kept = kept.withColumn("_j", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("_j") <= cap)
    j = F.col("_j") - 1
    return kept.select(key, F.format_string("%s_img%02d", F.col(key), j).alias("asset_id"),
                       F.lit("image").alias("asset_type"), "url", F.lit("").alias("wayback_url"),
                       content_hash(F.col("url")).alias("sha256"), F.lit("").alias("storage_uri"),
                       F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                       j.alias("asset_pos"), "alt")
