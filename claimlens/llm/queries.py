"""The operators' registered queries, with production parameters, over whole
tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlens.llm import anchors, block_names, bpe, licences, maxent, merkle, minhash, mixing, quality, render, repeats, syncmers, token_files
from claimlens.llm.common import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.exact_groups(documents(spark, sf_dir)).drop("key", "part")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).drop("key", "part", "repeats")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.rendered(table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(documents(spark, sf_dir))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir), threshold=85).drop("key", "part")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(documents(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.coded(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_fingerprints, op2_exact_dedup, op3_mixing, op4_quality, op5_html_text, op6_bpe,
                                    op7_licences, op8_repeats, op9_token_files, op10_near_dedup, op11_manifest, op12_lm_scores,
                                    op13_vector_codes)}


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_EXACT = f"""
WITH t AS (SELECT doc_id, sha256({_LOW}) AS text_sha256, {_LOW} AS low FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY low)"""

_REPEATS = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, list_aggregate(w[i:i + 19], 'string_agg', ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM again, range(20) t(j)),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM docs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS s, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM docs d LEFT JOIN kept USING (doc_id)"""


def _mixing_sql() -> str:
    """Targets in closed form (the sources that are capped have the smallest
    2 * size / weight), then the seeded cut, its top-ups, and fills by recursion
    until no untaken document fits."""
    tops = ""
    last = "cut"
    for i in range(mixing.TOP_UPS):
        tops += f""",
gap{i} AS (SELECT src, max(rest) - sum(size * extra) AS gap FROM {last} GROUP BY src),
best{i} AS (SELECT src, arg_max(doc_id, (size, -seeded, -doc_id)) AS doc_id FROM {last} JOIN gap{i} USING (src) WHERE extra = 0 AND size > 0 AND size <= gap GROUP BY src),
top{i} AS (SELECT c.* REPLACE (CASE WHEN b.doc_id IS NOT NULL THEN 1 ELSE c.extra END AS extra) FROM {last} c LEFT JOIN best{i} b ON b.src = c.src AND b.doc_id = c.doc_id)"""
        last = f"top{i}"
    return rf"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce('s' || source, 'n') AS src, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS seeded FROM documents),
src AS (SELECT src, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY min(source) NULLS LAST) AS n FROM docs GROUP BY src),
w AS (SELECT src, source_size, [3, 1, 2][((n - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size / [3, 1, 2][((n - 1) % 3 + 1)::INT] AS ratio, n FROM src),
steps AS (SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY ratio, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY ratio, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight, sum(source_size) OVER () AS total FROM w),
rates AS (SELECT *, (({mixing.SHARE}::DOUBLE * total) - capped::DOUBLE) / open_weight::DOUBLE AS rate FROM steps),
rate AS (SELECT arg_min(rate, (ratio, n)) FILTER (WHERE weight * rate <= 2.0::DOUBLE * source_size) AS rate FROM rates),
plan AS (SELECT src, source_size, CASE WHEN weight * rate > 2 * source_size OR rate IS NULL THEN 2.0::DOUBLE * source_size ELSE weight::DOUBLE * rate END AS target FROM w, rate),
share AS (SELECT *, CASE WHEN source_size > 0 THEN round_even(target, 0)::BIGINT // source_size ELSE 0 END AS passes, CASE WHEN source_size > 0 THEN round_even(target, 0)::BIGINT % source_size ELSE 0 END AS rest FROM plan),
cut AS (SELECT src, doc_id, size, seeded, source_size, target, passes, rest, (sum(size) OVER (PARTITION BY src ORDER BY seeded, doc_id ROWS UNBOUNDED PRECEDING) <= rest)::INT AS extra FROM docs JOIN share USING (src)){tops},
fill AS (SELECT 0 AS turn, src, doc_id, size, seeded, source_size, target, passes, rest, extra FROM {last}
    UNION ALL SELECT turn + 1, src, doc_id, size, seeded, source_size, target, passes, rest, CASE WHEN ok AND upto <= gap THEN 1 ELSE extra END
    FROM (SELECT *, sum(CASE WHEN ok THEN size ELSE 0 END) OVER (PARTITION BY src ORDER BY seeded, doc_id ROWS UNBOUNDED PRECEDING) AS upto, bool_or(ok) OVER () AS more
          FROM (SELECT *, extra = 0 AND size > 0 AND size <= gap AS ok FROM (SELECT *, max(rest) OVER (PARTITION BY src) - sum(size * extra) OVER (PARTITION BY src) AS gap FROM fill)))
    WHERE more)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN size * (passes + extra) ELSE 0 END::BIGINT AS taken FROM fill WHERE turn = (SELECT max(turn) FROM fill)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": _EXACT, "op3_mixing": _mixing_sql(), "op7_licences": licences.oracle(), "op8_repeats": _REPEATS,
            "op11_manifest": merkle.oracle(), "op13_vector_codes": anchors.oracle()}
