"""HTML -> rows Spark jobs.

``mapInPandas`` over the pages table: each Arrow batch of pages is parsed by
the stdlib helper in ``functions.html_parse`` and turned into section rows or
image-candidate rows.  Everything after the parse (filters, dedupe, caps, ids,
hashes) is ordinary Spark SQL.  The parse runs where the data was read and HTML
is not shuffled, unless the user asks for it (``session.spread``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..config import IMAGE_ATTRIBUTES, IMAGE_SELECTORS, MAX_FALLBACK_IMAGES, SECTION_SELECTORS
from ..functions import html_parse
from ..session import spread


def _key_fields(df: DataFrame, keys):
    by_name = {f.name: f for f in df.schema.fields}
    return [T.StructField(k, by_name[k].dataType, True) for k in keys]


def page_sections(pages: DataFrame, keys, html_col: str = "html", rules=SECTION_SELECTORS) -> DataFrame:
    """X01 + X02: ``(keys..., sec_ord, section, text)`` — title/description take
    the first match, bullets/A+ every non-empty match, in rule then document
    order; text is ``get_text(strip=True)`` (pieces joined with no separator)."""
    keys = list(keys)
    compiled = [(name, html_parse.compile_selector(sel), mode, limit) for name, sel, mode, limit in rules]
    schema = T.StructType(_key_fields(pages, keys) + [
        T.StructField("sec_ord", T.IntegerType(), True), T.StructField("section", T.StringType(), True),
        T.StructField("text", T.StringType(), True)])
    cols = [*keys, "sec_ord", "section", "text"]

    def run(batches):
        for pdf in batches:
            rows = []
            key_values = [pdf[k].tolist() for k in keys]
            for i, html in enumerate(pdf[html_col].tolist()):
                kv = tuple(v[i] for v in key_values)
                rows.extend(kv + sec for sec in html_parse.sections(html, compiled))
            yield pd.DataFrame(rows, columns=cols)

    return spread(pages.select(*keys, html_col)).mapInPandas(run, schema)


def image_candidates(pages: DataFrame, keys, url_col: str = "url", html_col: str = "html",
                     selectors=IMAGE_SELECTORS, attributes=IMAGE_ATTRIBUTES,
                     max_fallback: int = MAX_FALLBACK_IMAGES) -> DataFrame:
    """G06 + G07 + G10 + G13: ``(keys..., tier, pos, url, raw_src, alt)`` in the
    original nesting order (selector, element, attribute); tier 2 holds the
    first ``max_fallback`` <img> elements for the fallback rule."""
    keys = list(keys)
    compiled = [html_parse.compile_selector(s) for s in selectors]
    schema = T.StructType(_key_fields(pages, keys) + [
        T.StructField("tier", T.IntegerType(), True), T.StructField("pos", T.IntegerType(), True),
        T.StructField("url", T.StringType(), True), T.StructField("raw_src", T.StringType(), True),
        T.StructField("alt", T.StringType(), True)])
    cols = [*keys, "tier", "pos", "url", "raw_src", "alt"]
    attrs = tuple(attributes)

    def run(batches):
        for pdf in batches:
            rows = []
            key_values = [pdf[k].tolist() for k in keys]
            urls = pdf[url_col].tolist()
            for i, html in enumerate(pdf[html_col].tolist()):
                kv = tuple(v[i] for v in key_values)
                rows.extend(kv + c for c in html_parse.image_candidates(html, urls[i], compiled, attrs,
                                                                        max_fallback))
            yield pd.DataFrame(rows, columns=cols)

    return spread(pages.select(*dict.fromkeys([*keys, url_col, html_col]))).mapInPandas(run, schema)
