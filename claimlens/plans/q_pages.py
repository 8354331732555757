"""Page queries (G01-G15, D07, D11, X01/X02, G06-G13) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import html, pages
from . import inputs as I
from .oracle import lit
from .registry import query

_CAP_CTE = f"""cap AS (
  SELECT page_id AS page_ord, regexp_extract(url, {lit(I.PAGE_ID_PATTERN)}, 1) AS asin, url,
         CASE page_id % 7 WHEN 0 THEN 404 WHEN 1 THEN 0 ELSE 200 END AS status_code,
         CASE WHEN page_id % 11 = 0 THEN '' ELSE html END AS html,
         make_timestamp({I.CAPTURE_EPOCH_US} + page_id * 1000000 + (page_id % 2) * 250000) AS captured_at
  FROM pages)"""


def _iso_sql(ts: str) -> str:
    return (f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
            f"ELSE '.' || strftime({ts}, '%f') END || 'Z'")


def _captures(spark, sf_dir):
    return I.captures(I.load(spark, sf_dir, "pages"))


@query("page_hash", "SELECT page_id, sha256(html) AS page_sha256, length(html) AS n_chars FROM pages")
def page_hash(spark, sf_dir):
    """sha256 of every page body."""
    p = I.load(spark, sf_dir, "pages")
    return p.select("page_id", pages.content_hash(F.col("html")).alias("page_sha256"),
                    F.length("html").alias("n_chars"))


@query("page_filter", f"""WITH {_CAP_CTE}
SELECT page_ord, asin, sha256(html) AS page_sha256, {_iso_sql('captured_at')} AS captured_at, status_code
FROM cap WHERE status_code = 200 AND length(html) > 0""")
def page_filter(spark, sf_dir):
    """G02 + G04 + G14: successful captures -> page index with ISO-8601 times."""
    idx = pages.page_index(_captures(spark, sf_dir))
    return idx.select("page_ord", "asin", "page_sha256", pages.py_isoformat_z(F.col("captured_at"))
                      .alias("captured_at"), "status_code")


_HOST = f"lower(regexp_extract(url, {lit(pages.HOST_RE)}, 1))"


@query("domain_gate", f"""WITH rules AS (
  SELECT DISTINCT lower(regexp_extract(url, {lit(I.HOST_PATTERN)}, 1)) AS host FROM pages),
allow AS (SELECT host FROM rules WHERE NOT starts_with(host, 'm.') AND starts_with(host, 'blog.'))
SELECT page_id AS page_ord, {_HOST} AS host FROM pages WHERE {_HOST} IN (SELECT host FROM allow)""")
def domain_gate(spark, sf_dir):
    """G03 + D07: captures allowed by the per-host rules (no rule = deny)."""
    p = I.load(spark, sf_dir, "pages")
    caps = p.select(F.col("page_id").alias("page_ord"), "url")
    kept = pages.allowed_by_rules(caps, I.access_rules(p))
    return kept.select("page_ord", pages.url_host(F.col("url")).alias("host"))


@query("last_capture", f"""WITH {_CAP_CTE}
SELECT asin, min(page_ord) AS first_ord, arg_max(page_ord, page_ord) AS page_ord, arg_max(url, page_ord) AS url,
       arg_max(status_code, page_ord) AS status_code
FROM cap GROUP BY asin""")
def last_capture(spark, sf_dir):
    """One row per id, the last capture wins, first position kept."""
    from ..operators.normalize import latest_per_key
    c = _captures(spark, sf_dir).select("asin", "page_ord", "url", "status_code")
    return latest_per_key(c, "asin", "page_ord")


@query("archive_url", """SELECT page_id,
  CASE WHEN page_id % 5 = 0 THEN NULL
       WHEN page_id % 3 = 0 THEN 'https://web.archive.org/web/*/' || url
       WHEN page_id % 3 = 1 THEN 'https://web.archive.org' || '/web/20251112000000/' || url
       ELSE 'https://web.archive.org/web/20251112000001/' || url END AS wayback_url
FROM pages""")
def archive_url(spark, sf_dir):
    """Archive answers -> archive URL (absolute, placeholder or null)."""
    a = I.archive_answers(I.load(spark, sf_dir, "pages"))
    return a.select("page_id", pages.archive_url(F.col("archive_status"), F.col("location"), F.col("url"))
                    .alias("wayback_url"))


@query("page_integrity", f"""WITH {_CAP_CTE},
idx AS (SELECT page_ord, asin,
               CASE WHEN page_ord % 13 = 0 THEN sha256(html || ' ') ELSE sha256(html) END AS page_sha256
        FROM cap WHERE status_code = 200 AND length(html) > 0)
SELECT i.page_ord, i.asin, i.page_sha256, sha256(p.html) AS body_sha256,
       coalesce(i.page_sha256 = sha256(p.html), false) AS intact
FROM idx i LEFT JOIN pages p ON i.page_ord = p.page_id""")
def page_integrity(spark, sf_dir):
    """D11 (extension): re-hash stored bodies against the page index (every
    13th index entry carries a stale hash)."""
    p = I.load(spark, sf_dir, "pages")
    ok = pages.successful(I.captures(p))
    idx = ok.select("page_ord", "asin", F.when(F.col("page_ord") % 13 == 0, F.sha2(F.concat("html", F.lit(" ")), 256))
                    .otherwise(F.sha2("html", 256)).alias("page_sha256"))
    return pages.page_integrity(idx, p.select(F.col("page_id").alias("page_ord"), "html"))


@query("page_sections")
def page_sections(spark, sf_dir):
    """X01 + X02 on the supplied pages (title, bullets, description)."""
    p = I.load(spark, sf_dir, "pages")
    return html.page_sections(p, ["page_id"], rules=I.PAGE_SECTION_RULES)


@query("page_assets")
def page_assets(spark, sf_dir):
    """G06-G13 on pages with image markup: selector hits, JSON attribute,
    URL resolution, needle filter, dedupe, fallback, cap 10, ids and hashes."""
    p = I.image_pages(I.load(spark, sf_dir, "pages"))
    p = p.withColumn("asin", F.format_string("P%09d", F.col("page_id")))
    cand = html.image_candidates(p, ["asin"])
    a = pages.select_assets(cand, "asin")
    return a.select("asin", "asset_id", "asset_type", "url", "sha256", "asset_pos")
