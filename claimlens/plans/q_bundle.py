"""Registered queries of the bundle's Merkle tree and of version differences."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import bundle
from ..session import ensure_checkpoint_dir, written
from . import inputs as I
from .oracle import FX_CTE
from .registry import query

COLUMNS = ("claim_ord", "product_key", "claim_text", "origin", "cohort", "page_hash")
#: Levels that the SQL writes out: enough for 16^7 * 1024 rows.
_LEVELS = 7


def _claims(spark, sf_dir):
    return I.derived_claims(I.load(spark, sf_dir, "documents")).select(*COLUMNS)


def _tree_sql() -> str:
    field = "coalesce('V' || length({0}::VARCHAR) || ':' || {0}::VARCHAR, 'N')"
    text = " || ".join(field.format(c) for c in COLUMNS)
    sql = f"""WITH {FX_CTE},
dig AS MATERIALIZED (SELECT digest, count(*) AS copies FROM (SELECT sha256({text}) AS digest FROM fx) GROUP BY digest),
dep AS (SELECT greatest(1, ceil(log(greatest(1, sum(copies) / {bundle.BUCKET}.0)) / log(16)))::INT AS d FROM dig),
n0 AS (SELECT substr(digest, 1, (SELECT d FROM dep)) AS prefix, sha256(string_agg(digest || ':' || copies, '|' ORDER BY digest)) AS node, sum(copies) AS n_rows FROM dig GROUP BY 1)"""
    for k in range(1, _LEVELS + 1):
        sql += f""",
n{k} AS (SELECT substr(prefix, 1, length(prefix) - 1) AS prefix, sha256(string_agg(prefix || '=' || node, '|' ORDER BY prefix)) AS node, sum(n_rows) AS n_rows FROM n{k - 1} WHERE prefix <> '' GROUP BY 1)"""
    return sql + " " + " UNION ALL ".join(f"SELECT length(prefix)::INT AS level, prefix, node AS digest, n_rows::BIGINT AS n_rows FROM n{k}" for k in range(_LEVELS + 1))


@query("bundle_tree", _tree_sql())
def bundle_tree(spark, sf_dir):
    """Every node of the claims table's Merkle tree, down from the root."""
    return bundle.tree(bundle.digested(_claims(spark, sf_dir)))


def seeded_version(claims):
    """Fixture: a later version of the table, by claim_ord: % 97 = 5 are gone, %
    89 = 3 have another origin, % 101 = 7 come a second time under a new id."""
    kept = claims.where("claim_ord % 97 <> 5").withColumn("origin", F.when(F.col("claim_ord") % 89 == 3, F.lit("image")).otherwise(F.col("origin")))
    return kept.unionByName(claims.where("claim_ord % 101 = 7").withColumn("claim_ord", F.col("claim_ord") + 1_000_000_000_000))


@query("bundle_diff", f"""WITH {FX_CTE},
old AS (SELECT {", ".join(COLUMNS)} FROM fx),
new AS (SELECT * REPLACE (CASE WHEN claim_ord % 89 = 3 THEN 'image' ELSE origin END AS origin) FROM old WHERE claim_ord % 97 <> 5
        UNION ALL SELECT * REPLACE (claim_ord + 1000000000000 AS claim_ord) FROM old WHERE claim_ord % 101 = 7)
SELECT CASE WHEN o.claim_ord IS NULL THEN 'added' WHEN n.claim_ord IS NULL THEN 'removed' ELSE 'changed' END AS change,
       coalesce(o.claim_ord, n.claim_ord) AS claim_ord, o.origin AS old_origin, n.origin AS new_origin, o.claim_text AS old_claim_text, n.claim_text AS new_claim_text
FROM old o FULL JOIN new n USING (claim_ord) WHERE o.claim_ord IS NULL OR n.claim_ord IS NULL OR o.origin <> n.origin""")
def bundle_diff(spark, sf_dir):
    """Two written versions of the claims table, compared from their
    roots down; rows are read only for buckets that differ."""
    folder = f"{ensure_checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    claims = written(_claims(spark, sf_dir), "bundle-claims")
    for name, version in (("old", claims), ("new", seeded_version(claims))):
        bundle.write_version(version, f"{folder}/{name}")
    changes = bundle.diff(spark, f"{folder}/old", f"{folder}/new")
    return bundle.changed_keys(changes, "claim_ord", ("origin", "claim_text"))
